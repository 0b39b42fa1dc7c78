"""Writers of result bundles."""

"""Area tables, rates, thresholds, word lists and names.

Everything in this module is data that must equal the published analyses for
results to agree; no logic lives here.
"""

# Months.
MONTHS = (
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
)
SEASON_MONTHS = ("May", "June", "July", "August", "September", "October")
NATIONS_MONTHS = ("June", "July", "August", "September")
MONTH_TOKENS = {"Jun": "June", "Jul": "July", "Aug": "August", "Sep": "September"}
MONTH_SHORT = {"Aug": "August", "Sept": "September"}

# Sport sub-areas of each run-reconstruction area.
CONUMA_SPORT_AREAS = {
    "Tlupana": ("25D",),
    "Muchalat": ("25L",),
    "Inner Esperanza": ("25E", "25F", "25JI"),
    "Outer Nootka/corridor": ("25I", "25PO"),
    "Outer Esperanza/corridor": ("25JO", "25K"),
    "Inner Nootka": ("25M", "25N", "25O", "25PI"),
}
NITINAT_SPORT_AREAS = {
    "Area 21 Terminal": ("21A", "21B", "Area 21"),
    "Outer Nitinat corridor": ("121C",),
    "Nitinat Lake and River": ("22A",),
}

# Sub-areas accepted on sport samples.
CONUMA_SAMPLE_SUB_AREAS = (
    "25PI", "25JO", "125Q", "25JI", "25L", "25N", "25PO", "25F",
    "125A", "25E", "25D", "125G", "125K", "25O", "25I",
)
NITINAT_SAMPLE_SUB_AREAS = CONUMA_SAMPLE_SUB_AREAS + ("21A", "21B", "22A", "121C")

# Gear words and release mortality rates.
SAMPLE_GEARS = {"TROLL": "Troll", "SEINE": "Seine", "GILL NET": "Gillnet"}
LICENCE_GEARS = {"Gillnet": "Gillnet", "Troll": "Troll", "Seine": "Seine"}
SPORT_RELEASE_RATE = 0.2
COMMERCIAL_RELEASE_RATES = {"Gillnet": 0.5, "Seine": 0.2, "Troll": 0.2}
SPORT_SPECIES = "CHINOOK SALMON"
MARK_SPECIES = "Chinook"
DISPOSITIONS = ("Kept", "Released Legal", "Released Sub-legal")

# Source text of the Five Nations catch and the area it stands for.
NATIONS_SECTOR = "5 Nations EO"
NATIONS_AREAS = {
    "(ISBM Conuma)|(AABM)": "5 Nations Outer Nootka",
    "ISBM Muchalaht": "5 Nations Muchalat",
    "Conuma ESSR": "5 Nations Conuma ESSR",
}
NATIONS_UNKNOWN = "FLAG"
NATIONS_GSI_AREA = "5 Nations Outer Nootka"

# Hatchery report lines that are notes or subtotals.
REPORT_NOTE_LINES = (
    "Number of fish given to others",
    "Culls",
    "Morts",
    "0",
    "Total",
    "Additional estimate NOT counted or sampled for marks:",
    "Total Hatchery estimate of Native Fishery:",
    "Total Hatchery staff estimate of natural spawners:",
)
REPORT_NOTE_TEXT = ("TOTAL", "If Applicable", "River was open", "Not including broodstock")
REPORT_SEXES = ("U", "M", "F", "J", "I")
NATURAL_SPAWNERS = "TOTAL NATURAL SPAWNING RIVER POPULATION"
FISH_REMOVED = "FISH REMOVED FROM THE SYSTEM:"

# Coarse catch regions, first match wins.
# (name, whole management areas, sub-areas, sub-areas count only inside this management area)
CATCH_REGIONS = (
    ("outSmith(10)", ("PFMA 10",), (), None),
    ("upperQCS(11,111)", ("PFMA 11", "PFMA 111"), (), None),
    ("nJST(12)", ("PFMA 12",), (), None),
    ("nGST(13,14,15,16)", ("PFMA 13", "PFMA 14", "PFMA 15", "PFMA 16"), (), None),
    ("sGST(17,18,19AB,28,29)", ("PFMA 17", "PFMA 18", "PFMA 28", "PFMA 29"),
     ("19A", "19B", "Area 19 (GS)"), None),
    ("JDFeast(19CDE,20CD)", (),
     ("20DB", "20DI", "20DO", "19C", "19D", "19E", "20C", "20D", "Area 19 (JDF)", "Area 20 (East)"), None),
    ("JDFwest(Renfrew 20ABE)", (), ("20A", "20B", "20E", "Area 20 (West)", "Area 20 (WCVI)"), None),
    ("Nitinat", ("PFMA 21",), (), None),
    ("Alberni(23A,B)", (), ("23A", "23B", "Area 23 (Alberni Canal)"), "PFMA 23"),
    ("Barkley(23C-Q)", (),
     ("23C", "23D", "23E", "23F", "23G", "23H", "23I", "23J", "23K", "23L", "23M", "23N", "23O", "23P",
      "23Q", "Area 23", "Area 23 (Barkley)"), "PFMA 23"),
    ("Clayoquot", ("PFMA 24",), (), None),
    ("Nootka/Esp", ("PFMA 25",), (), None),
    ("Kyuquot", ("PFMA 26",), (), None),
    ("Quatsino", ("PFMA 27",), (), None),
    ("SWVIoutside-1nm121-124", ("PFMA 121", "PFMA 122", "PFMA 123", "PFMA 124"), (), None),
    ("NWVI-1nm-corridor125-127", ("PFMA 125", "PFMA 126", "PFMA 127"), (), None),
)
US_REGION_TEXT = "US7"

# Genetic regions and age codes.
GENETIC_REGIONS = {"NoKy": "NWVI", "SWVI": "SWVI", "NPS": "Puget Sound"}
GILBERT_RICH_AGES = {
    "21": "2", "1M": "2", "31": "3", "2M": "3", "41": "4", "3M": "4", "51": "5", "4M": "5", "61": "6", "5M": "6",
}
BROODSTOCK_GR_AGES = ("21", "31", "41", "51", "1M", "2M", "3M", "4M")
BROODSTOCK_PROJECT = "CONUMA RIVER HATCHERY -2021"
BROODSTOCK_REGION = "WCVI"
BROODSTOCK_SOURCE = "SEP Conuma Hatchery broodstock age data"

# Thresholds. Genetic results give percent, the sample table a fraction.
GSI_MIN_PERCENT = 75
QC_MIN_FRACTION = 0.8
MIN_SAMPLES = 10
CATCH_SIZE_STEPS = ((500, 4), (1000, 7), (1500, 10))
CATCH_SIZE_TOP = 14
SAMPLE_SIZE_STEPS = ((10, 3), (50, 6), (75, 8), (100, 10))
SAMPLE_SIZE_TOP = 12

# Stock groups.
WCVI_ROLLUPS = ("NWVI", "SWVI")
NAME_SUFFIX = r"\b( River| Creek)\b"
FOCAL_STOCKS = {
    "term_con": ("BEDWELL", "BURMAN", "CONUMA", "KAOUK", "MARBLE", "NITINAT", "ROBERTSON", "SAN JUAN"),
    "term_nit": ("CONUMA", "NITINAT", "ROBERTSON", "SAN JUAN"),
    "term_area23": ("CONUMA", "NITIANT", "ROBERTSON"),
}
# The published area-23 list spells one stock "NITIANT"; this is the list with the name put right.
FOCAL_STOCKS_SPELLED = dict(FOCAL_STOCKS, term_area23=("CONUMA", "NITINAT", "ROBERTSON"))
STREAM_RENAMES = {"Qualicum River": "Big Qualicum River", "Tranquil Creek": "Tranquil River"}
EXTRA_STREAMS = (("Robertson Creek", 23), ("Omega Pacific Hatchery", 23))

# Hatchery linkage.
FACILITY_RENAMES = {"H-ROBERTSON CR": "H-ROBERTSON CREEK H", "H-CONUMA R ": "H-CONUMA RIVER H "}
UNREADABLE_SCALES = ("RG", "UD", "LL", "NS")
MARK_COLUMNS = (
    "brood_year", "agency", "facility", "release_year", "stock", "hatch_code", "state_province", "site",
)
TAG_COLUMNS = (
    "tagcode", "species_name", "project_name", "brood_year", "release_year", "stock_site_name",
    "stock_psc_region_name", "hatchery_site_name", "hatchery_psc_region_name", "release_site_name",
    "release_psc_region_name", "stage_code",
)
READING_KEYS = (
    "container_id", "batch_id", "project_name", "region", "area", "species", "recovery_year", "life_history",
)

# Display names used by the sinks.
LINK_DISPLAY = {
    "r_otolith_box_num": "(R) OTOLITH BOX NUM",
    "r_otolith_vial_num": "(R) OTOLITH VIAL NUM",
    "r_otolith_box_vial_concat": "(R) OTOLITH BOX-VIAL CONCAT",
    "r_scale_book_num": "(R) SCALE BOOK NUM",
    "r_scale_cell_num": "(R) SCALE CELL NUM",
    "r_scale_book_cell_concat": "(R) SCALE BOOK-CELL CONCAT",
    "r_tagcode": "(R) TAGCODE",
    "r_sample_year": "(R) SAMPLE YEAR",
    "r_brood_year": "(R) BROOD YEAR",
    "r_hatch_code": "(R) HATCH CODE",
    "r_resolved_gr_age": "(R) RESOLVED GR AGE",
    "r_resolved_total_age": "(R) RESOLVED TOTAL AGE",
    "r_resolved_stock_id": "(R) RESOLVED STOCK ID",
}
CODED_DISPLAY = {
    "hat_nat": "Hat/Nat (R)",
    "stock_group": "Stock group (R)",
    "term_sum": "Term Sum (R)",
    "term_con": "TermCON (R)",
    "term_nit": "TermNIT (R)",
    "term_area23": "TermArea23 (R)",
    "qc_term_con_nit": "qcFlag_TermCON=TermNIT?",
    "qc_term_con_23": "qcFlag_TermCON=Term23?",
    "qc_term_nit_23": "qcFlag_TermNIT=Term23?",
}


def orphan_display(year: int) -> dict[str, str]:
    return {
        "sector": "Sector",
        "run_recon_area": "Run reconstruction area",
        "total_kept": f"CK caught in {year}",
        "n_age_samples": "# Resolved age samples",
        "n_stockcomp_samples": "# Resolved stock comp samples",
        "age_samplesize_flag": "Flag for # age samples (<10)",
        "stockcomp_samplesize_flag": "Flag for # stock comp samples (<10)",
    }

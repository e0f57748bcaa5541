"""Fixed values the results depend on.

Everything in this module is data, not logic: lookup tables, word lists and
seed rows whose exact spelling and order decide the output. They are kept
together, in their natural order, so they can be read and audited at once.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES: jurisdiction -> US Census division (50 states + DC).
# Anything else (national totals, cities, territories) maps to nothing and is
# dropped by staging.
# ---------------------------------------------------------------------------
STATE_DIVISION: dict[str, str] = {
    "CONNECTICUT": "NEW ENGLAND",
    "MAINE": "NEW ENGLAND",
    "MASSACHUSETTS": "NEW ENGLAND",
    "NEW HAMPSHIRE": "NEW ENGLAND",
    "RHODE ISLAND": "NEW ENGLAND",
    "VERMONT": "NEW ENGLAND",
    "NEW JERSEY": "MIDDLE ATLANTIC",
    "NEW YORK": "MIDDLE ATLANTIC",
    "PENNSYLVANIA": "MIDDLE ATLANTIC",
    "ILLINOIS": "EAST NORTH CENTRAL",
    "INDIANA": "EAST NORTH CENTRAL",
    "MICHIGAN": "EAST NORTH CENTRAL",
    "OHIO": "EAST NORTH CENTRAL",
    "WISCONSIN": "EAST NORTH CENTRAL",
    "IOWA": "WEST NORTH CENTRAL",
    "KANSAS": "WEST NORTH CENTRAL",
    "MINNESOTA": "WEST NORTH CENTRAL",
    "MISSOURI": "WEST NORTH CENTRAL",
    "NEBRASKA": "WEST NORTH CENTRAL",
    "NORTH DAKOTA": "WEST NORTH CENTRAL",
    "SOUTH DAKOTA": "WEST NORTH CENTRAL",
    "DELAWARE": "SOUTH ATLANTIC",
    "FLORIDA": "SOUTH ATLANTIC",
    "GEORGIA": "SOUTH ATLANTIC",
    "MARYLAND": "SOUTH ATLANTIC",
    "NORTH CAROLINA": "SOUTH ATLANTIC",
    "SOUTH CAROLINA": "SOUTH ATLANTIC",
    "VIRGINIA": "SOUTH ATLANTIC",
    "WEST VIRGINIA": "SOUTH ATLANTIC",
    "DISTRICT OF COLUMBIA": "SOUTH ATLANTIC",
    "ALABAMA": "EAST SOUTH CENTRAL",
    "KENTUCKY": "EAST SOUTH CENTRAL",
    "MISSISSIPPI": "EAST SOUTH CENTRAL",
    "TENNESSEE": "EAST SOUTH CENTRAL",
    "ARKANSAS": "WEST SOUTH CENTRAL",
    "LOUISIANA": "WEST SOUTH CENTRAL",
    "OKLAHOMA": "WEST SOUTH CENTRAL",
    "TEXAS": "WEST SOUTH CENTRAL",
    "ARIZONA": "MOUNTAIN",
    "COLORADO": "MOUNTAIN",
    "IDAHO": "MOUNTAIN",
    "MONTANA": "MOUNTAIN",
    "NEVADA": "MOUNTAIN",
    "NEW MEXICO": "MOUNTAIN",
    "UTAH": "MOUNTAIN",
    "WYOMING": "MOUNTAIN",
    "ALASKA": "PACIFIC",
    "CALIFORNIA": "PACIFIC",
    "HAWAII": "PACIFIC",
    "OREGON": "PACIFIC",
    "WASHINGTON": "PACIFIC",
}

# ---------------------------------------------------------------------------
# FIXED VALUES: state -> two-letter postal code.
# WASHINGTON is WA here. The source model this library follows wrote "DC" for
# it, which its own accepted-values test and the separate DISTRICT OF COLUMBIA
# entry contradict; pass STATE_ABBREVIATION_AS_SHIPPED to reproduce that.
# ---------------------------------------------------------------------------
STATE_ABBREVIATION: dict[str, str] = {
    "ALABAMA": "AL",
    "ALASKA": "AK",
    "ARIZONA": "AZ",
    "ARKANSAS": "AR",
    "CALIFORNIA": "CA",
    "COLORADO": "CO",
    "CONNECTICUT": "CT",
    "DISTRICT OF COLUMBIA": "DC",
    "DELAWARE": "DE",
    "FLORIDA": "FL",
    "GEORGIA": "GA",
    "HAWAII": "HI",
    "IDAHO": "ID",
    "ILLINOIS": "IL",
    "INDIANA": "IN",
    "IOWA": "IA",
    "KANSAS": "KS",
    "KENTUCKY": "KY",
    "LOUISIANA": "LA",
    "MAINE": "ME",
    "MARYLAND": "MD",
    "MASSACHUSETTS": "MA",
    "MICHIGAN": "MI",
    "MINNESOTA": "MN",
    "MISSISSIPPI": "MS",
    "MISSOURI": "MO",
    "MONTANA": "MT",
    "NEBRASKA": "NE",
    "NEVADA": "NV",
    "NEW HAMPSHIRE": "NH",
    "NEW JERSEY": "NJ",
    "NEW MEXICO": "NM",
    "NEW YORK": "NY",
    "NORTH CAROLINA": "NC",
    "NORTH DAKOTA": "ND",
    "OHIO": "OH",
    "OKLAHOMA": "OK",
    "OREGON": "OR",
    "PENNSYLVANIA": "PA",
    "RHODE ISLAND": "RI",
    "SOUTH CAROLINA": "SC",
    "SOUTH DAKOTA": "SD",
    "TENNESSEE": "TN",
    "TEXAS": "TX",
    "UTAH": "UT",
    "VERMONT": "VT",
    "VIRGINIA": "VA",
    "WASHINGTON": "WA",
    "WEST VIRGINIA": "WV",
    "WISCONSIN": "WI",
    "WYOMING": "WY",
}

STATE_ABBREVIATION_AS_SHIPPED: dict[str, str] = {**STATE_ABBREVIATION, "WASHINGTON": "DC"}

# ---------------------------------------------------------------------------
# FIXED VALUES: Census division -> Census region.
# ---------------------------------------------------------------------------
DIVISION_REGION: dict[str, str] = {
    "NEW ENGLAND": "NORTHEAST",
    "MIDDLE ATLANTIC": "NORTHEAST",
    "EAST NORTH CENTRAL": "MIDWEST",
    "WEST NORTH CENTRAL": "MIDWEST",
    "SOUTH ATLANTIC": "SOUTH",
    "EAST SOUTH CENTRAL": "SOUTH",
    "WEST SOUTH CENTRAL": "SOUTH",
    "MOUNTAIN": "WEST",
    "PACIFIC": "WEST",
}

# ---------------------------------------------------------------------------
# FIXED VALUES: disease-name normalisation in staging.
# ---------------------------------------------------------------------------
TOTAL_SUFFIX_LIKE = "%, TOTAL"
DISEASE_TEXT_FIXES: list[tuple[str, str]] = [
    ("SALMONELLAPARATYPHI", "SALMONELLA PARATYPHI"),
]

# ---------------------------------------------------------------------------
# FIXED VALUES: disease attributes parsed from the long name. Each list is
# ordered; the first pattern found wins, otherwise "N/A".
# ---------------------------------------------------------------------------
DISEASE_STATUS_RULES: list[tuple[str, str]] = [
    ("CONFIRMED", "Confirmed"),
    ("PROBABLE", "Probable"),
    ("SUSPECT", "Suspect"),
]

DISEASE_DEMOGRAPHIC_RULES: list[tuple[str, str]] = [
    ("INFANTS", "Infant"),
    ("INFANT", "Infant"),
    ("PEDIATRIC", "Pediatric"),
    ("<5 YEARS", "Under 5 Years"),
    ("ALL AGES", "All Ages"),
    ("OTHER", "Other"),
]

DISEASE_CATEGORY_RULES: list[tuple[str, str]] = [
    ("FOODBORNE", "Foodborne"),
    ("WATERBORNE", "Waterborne"),
    ("ARBOVIRAL", "Arboviral/Vector-borne"),
    ("PERINATAL", "Perinatal"),
    ("NON-CONGENITAL", "Non-Congenital"),
    ("CONGENITAL", "Congenital"),
    ("PRIMARY AND SECONDARY", "Primary/Secondary"),
]

DISEASE_SEVERITY_RULES: list[tuple[str, str]] = [
    ("ACUTE", "Acute"),
    ("CHRONIC", "Chronic"),
]

DISEASE_SUBTYPE_RULES: list[tuple[str, str]] = [
    ("SEROGROUP B", "Serogroup B"),
    ("SEROGROUPS ACWY", "Serogroups ACWY"),
    ("OTHER SEROGROUPS", "Other Serogroups"),
    ("ALL SEROGROUPS", "All Serogroups"),
    ("UNKNOWN SEROGROUP", "Unknown Serogroup"),
    ("NON-B SEROTYPE", "Non-B Serotype"),
    ("NONTYPEABLE", "Nontypeable"),
    ("SEROTYPE B", "Serotype B"),
    ("UNKNOWN SEROTYPE", "Unknown Serotype"),
    ("ALL SEROTYPES", "All Serotypes"),
]

DISEASE_DETECTION_RULES: list[tuple[str, str]] = [
    ("SCREENING", "Screening"),
    ("CLINICAL", "Clinical"),
]

# Matched at the start of the name, not anywhere in it.
DISEASE_GROUP_PREFIX_RULES: list[tuple[str, str]] = [
    ("ARBOVIRAL DISEASES", "Arboviral Diseases"),
    ("EHRLICHIOSIS AND ANAPLASMOSIS", "Ehrlichiosis and Anaplasmosis"),
    ("HAEMOPHILUS INFLUENZAE", "Haemophilus Influenzae"),
    ("HEPATITIS", "Hepatitis"),
    ("VIRAL HEMORRHAGIC FEVERS", "Viral Hemorrhagic Fevers"),
    ("DENGUE VIRUS INFECTIONS", "Dengue Virus Infections"),
]

# Names containing this have no disease-dimension row.
DISEASE_EXCLUDE_CONTAINS = "ASSOCIATED"

# ---------------------------------------------------------------------------
# FIXED VALUES: short disease name. First, for a name starting with
# `prefix`, every occurrence of `text` is removed (first matching prefix wins).
# Then every "[,-]? <space>* (modifier)" is removed, in this alternation
# order (leftmost alternative wins, so longer forms precede their parts).
# The list is regex source; UNKNOWN SEROTYPE really appears twice.
# ---------------------------------------------------------------------------
SHORT_NAME_STRIP_RULES: list[tuple[str, str]] = [
    ("ARBOVIRAL DISEASES, ", "ARBOVIRAL DISEASES, "),
    ("EHRLICHIOSIS AND ANAPLASMOSIS, ", "EHRLICHIOSIS AND ANAPLASMOSIS, "),
    ("DENGUE VIRUS INFECTIONS, ", "DENGUE VIRUS INFECTIONS, "),
    ("VIRAL HEMORRHAGIC FEVERS, ", "VIRAL HEMORRHAGIC FEVERS, "),
    ("HAEMOPHILUS INFLUENZAE", ", INVASIVE DISEASE"),
]

DISEASE_MODIFIERS: list[str] = [
    "CONFIRMED",
    "PROBABLE",
    "SUSPECT",
    "INFANTS",
    "INFANT",
    "PEDIATRIC",
    "CONGENITAL SYNDROME",
    "NON-CONGENITAL",
    "CONGENITAL",
    "FOODBORNE",
    "WATERBORNE",
    "ACUTE",
    "CHRONIC",
    "ALL SEROGROUPS",
    "OTHER SEROGROUPS",
    "SEROGROUPS ACWY",
    "SEROGROUP B",
    "UNKNOWN SEROGROUP",
    "UNKNOWN SEROTYPE",
    "NONPARALYTIC",
    "PARALYTIC",
    "AGE <5 YEARS",
    "ALL AGES",
    "CLINICAL",
    "SCREENING",
    "HUMAN",
    "ANIMAL",
    "PRIMARY AND SECONDARY",
    "PERINATAL INFECTION",
    "PERINATAL",
    r"OTHER \(WOUND & UNSPECIFIED\)",
    "NON-B SEROTYPE",
    "NONTYPEABLE",
    "SEROTYPE B",
    "UNKNOWN SEROTYPE",
    "ALL SEROTYPES",
]

# ---------------------------------------------------------------------------
# FIXED VALUES: week bands of the date dimension (inclusive week ranges).
# Week 53 has no quarter and no half; the season falls through to WINTER.
# ---------------------------------------------------------------------------
QUARTER_BANDS: list[tuple[int, int, str]] = [(1, 13, "Q1"), (14, 26, "Q2"), (27, 39, "Q3"), (40, 52, "Q4")]
HALF_BANDS: list[tuple[int, int, str]] = [(1, 26, "H1"), (27, 52, "H2")]
SEASON_BANDS: list[tuple[int, int, str]] = [(14, 26, "SPRING"), (27, 39, "SUMMER"), (40, 48, "FALL")]
SEASON_OTHERWISE = "WINTER"
NO_HOLIDAY = "N/A"

# ---------------------------------------------------------------------------
# FIXED VALUES: marts.
# ---------------------------------------------------------------------------
NOT_COUNTED_FLAG = "-"                                   # flagged = flag != '-'
SEASON_FLAGS: list[str] = ["U", "N", "NN", "NP", "NC"]   # flagged = flag in (...)
SEASON_FIRST_YEAR, SEASON_LAST_YEAR = 2022, 2026
TOP_N = 5

# ---------------------------------------------------------------------------
# FIXED VALUES: surrogate keys (placeholder for a null part, part separator).
# ---------------------------------------------------------------------------
SURROGATE_NULL = "_dbt_utils_surrogate_key_null_"
SURROGATE_SEP = "-"

# ---------------------------------------------------------------------------
# FIXED VALUES: incremental load.
# ---------------------------------------------------------------------------
NATURAL_KEY: list[str] = ["states", "year", "week", "label"]
DEFAULT_START: tuple[int, int] = (2022, 0)
BACKFILL_YEARS: tuple[int, int] = (2022, 2026)

# ---------------------------------------------------------------------------
# FIXED VALUES: accepted values of the declared data tests.
# ---------------------------------------------------------------------------
ACCEPTED_WEEKS: list[int] = list(range(1, 54))
ACCEPTED_FLAGS: list[str] = ["U", "--", "N", "NN", "NP", "NC"]
ACCEPTED_DIVISIONS: list[str] = [
    "EAST NORTH CENTRAL", "EAST SOUTH CENTRAL", "MIDDLE ATLANTIC",
    "MOUNTAIN", "NEW ENGLAND", "PACIFIC", "SOUTH ATLANTIC",
    "WEST NORTH CENTRAL", "WEST SOUTH CENTRAL",
]
ACCEPTED_QUARTERS = ["Q1", "Q2", "Q3", "Q4"]
ACCEPTED_HALVES = ["H1", "H2"]
ACCEPTED_SEASONS = ["SPRING", "SUMMER", "FALL", "WINTER"]
ACCEPTED_BOOLEANS = [True, False]
ACCEPTED_STATUS = ["Confirmed", "Probable", "Suspect", "N/A"]
ACCEPTED_DEMOGRAPHIC = ["Infant", "Pediatric", "Under 5 Years", "All Ages", "Other", "N/A"]
ACCEPTED_CATEGORY = ["Foodborne", "Waterborne", "Arboviral/Vector-borne", "Perinatal",
                     "Non-Congenital", "Congenital", "Primary/Secondary", "N/A"]
ACCEPTED_SEVERITY = ["Acute", "Chronic", "N/A"]
ACCEPTED_SUBTYPE = ["Serogroup B", "Serogroups ACWY", "Other Serogroups", "All Serogroups",
                    "Unknown Serogroup", "Non-B Serotype", "Nontypeable", "Serotype B",
                    "Unknown Serotype", "All Serotypes", "N/A"]
ACCEPTED_DETECTION = ["Screening", "Clinical", "N/A"]
ACCEPTED_GROUP = ["Arboviral Diseases", "Ehrlichiosis and Anaplasmosis", "Haemophilus Influenzae",
                  "Hepatitis", "Viral Hemorrhagic Fevers", "Dengue Virus Infections", "N/A"]
ACCEPTED_ABBREVIATIONS = ["AL", "AK", "AZ", "AR", "CA", "CO", "CT", "DE", "DC", "FL", "GA", "HI", "ID",
                          "IL", "IN", "IA", "KS", "KY", "LA", "ME", "MD", "MA", "MI", "MN", "MS", "MO",
                          "MT", "NE", "NV", "NH", "NJ", "NM", "NY", "NC", "ND", "OH", "OK", "OR", "PA",
                          "RI", "SC", "SD", "TN", "TX", "UT", "VT", "VA", "WA", "WV", "WI", "WY"]
ACCEPTED_CENSUS = ["NORTHEAST", "MIDWEST", "SOUTH", "WEST"]

# ---------------------------------------------------------------------------
# FIXED VALUES: seed `disease_list` (disease_name), 133 rows, seed order.
# ---------------------------------------------------------------------------
DISEASE_LIST: list[str] = [
    "ANTHRAX",
    "ARBOVIRAL DISEASES, CHIKUNGUNYA VIRUS DISEASE",
    "ARBOVIRAL DISEASES, EASTERN EQUINE ENCEPHALITIS VIRUS DISEASE",
    "ARBOVIRAL DISEASES, JAMESTOWN CANYON VIRUS DISEASE",
    "ARBOVIRAL DISEASES, LA CROSSE VIRUS DISEASE",
    "ARBOVIRAL DISEASES, POWASSAN VIRUS DISEASE",
    "ARBOVIRAL DISEASES, ST. LOUIS ENCEPHALITIS VIRUS DISEASE",
    "ARBOVIRAL DISEASES, WEST NILE VIRUS DISEASE",
    "ARBOVIRAL DISEASES, WESTERN EQUINE ENCEPHALITIS VIRUS DISEASE",
    "BABESIOSIS",
    "BOTULISM, FOODBORNE",
    "BOTULISM, INFANT",
    "BOTULISM, OTHER (WOUND & UNSPECIFIED)",
    "BRUCELLOSIS",
    "CAMPYLOBACTERIOSIS",
    "CANDIDA AURIS, CLINICAL",
    "CANDIDA AURIS, SCREENING",
    "CARBAPENEMASE-PRODUCING CARBAPENEM-RESISTANT ENTEROBACTERIACEAE",
    "CHANCROID",
    "CHLAMYDIA TRACHOMATIS INFECTION",
    "CHOLERA",
    "COCCIDIOIDOMYCOSIS",
    "COCCIDIOIDOMYCOSIS, CONFIRMED",
    "COCCIDIOIDOMYCOSIS, PROBABLE",
    "COVID-19-ASSOCIATED PEDIATRIC MORTALITY",
    "CRONOBACTER INVASIVE INFECTION, INFANTS, CONFIRMED",
    "CRONOBACTER INVASIVE INFECTION, INFANTS, PROBABLE",
    "CRYPTOSPORIDIOSIS",
    "CYCLOSPORIASIS",
    "DENGUE VIRUS INFECTIONS, DENGUE",
    "DENGUE VIRUS INFECTIONS, DENGUE-LIKE ILLNESS",
    "DENGUE VIRUS INFECTIONS, SEVERE DENGUE",
    "EHRLICHIOSIS AND ANAPLASMOSIS, ANAPLASMA PHAGOCYTOPHILUM INFECTION",
    "EHRLICHIOSIS AND ANAPLASMOSIS, EHRLICHIA CHAFFEENSIS INFECTION",
    "EHRLICHIOSIS AND ANAPLASMOSIS, EHRLICHIA EWINGII INFECTION",
    "EHRLICHIOSIS AND ANAPLASMOSIS, UNDETERMINED EHRLICHIOSIS/ANAPLASMOSIS",
    "GIARDIASIS",
    "GONORRHEA",
    "HAEMOPHILUS INFLUENZAE, INVASIVE DISEASE, AGE <5 YEARS, NON-B SEROTYPE",
    "HAEMOPHILUS INFLUENZAE, INVASIVE DISEASE, AGE <5 YEARS, NONTYPEABLE",
    "HAEMOPHILUS INFLUENZAE, INVASIVE DISEASE, AGE <5 YEARS, SEROTYPE B",
    "HAEMOPHILUS INFLUENZAE, INVASIVE DISEASE, AGE <5 YEARS, UNKNOWN SEROTYPE",
    "HAEMOPHILUS INFLUENZAE, INVASIVE DISEASE, ALL AGES, ALL SEROTYPES",
    "HANSEN'S DISEASE",
    "HANTAVIRUS INFECTION, NON-HANTAVIRUS PULMONARY SYNDROME",
    "HANTAVIRUS PULMONARY SYNDROME",
    "HEMOLYTIC UREMIC SYNDROME POST-DIARRHEAL",
    "HEPATITIS A, CONFIRMED",
    "HEPATITIS B, ACUTE",
    "HEPATITIS B, ACUTE, CONFIRMED",
    "HEPATITIS B, ACUTE, PROBABLE",
    "HEPATITIS B, CHRONIC, CONFIRMED",
    "HEPATITIS B, CHRONIC, PROBABLE",
    "HEPATITIS B, PERINATAL INFECTION",
    "HEPATITIS B, PERINATAL, CONFIRMED",
    "HEPATITIS C, ACUTE, CONFIRMED",
    "HEPATITIS C, ACUTE, PROBABLE",
    "HEPATITIS C, CHRONIC, CONFIRMED",
    "HEPATITIS C, CHRONIC, PROBABLE",
    "HEPATITIS C, PERINATAL INFECTION",
    "HEPATITIS C, PERINATAL, CONFIRMED",
    "HEPATITIS, A, ACUTE",
    "HEPATITIS, B, ACUTE",
    "INFLUENZA-ASSOCIATED PEDIATRIC MORTALITY",
    "INVASIVE PNEUMOCOCCAL DISEASE, AGE <5 YEARS, CONFIRMED",
    "INVASIVE PNEUMOCOCCAL DISEASE, AGE <5 YEARS, PROBABLE",
    "INVASIVE PNEUMOCOCCAL DISEASE, ALL AGES, CONFIRMED",
    "INVASIVE PNEUMOCOCCAL DISEASE, ALL AGES, PROBABLE",
    "LEGIONELLOSIS",
    "LEPROSY (HANSEN'S DISEASE)",
    "LEPTOSPIROSIS",
    "LISTERIOSIS, CONFIRMED",
    "LISTERIOSIS, PROBABLE",
    "MALARIA",
    "MEASLES, IMPORTED",
    "MEASLES, INDIGENOUS",
    "MELIOIDOSIS",
    "MENINGOCOCCAL DISEASE, ALL SEROGROUPS",
    "MENINGOCOCCAL DISEASE, OTHER SEROGROUPS",
    "MENINGOCOCCAL DISEASE, SEROGROUP B",
    "MENINGOCOCCAL DISEASE, SEROGROUPS ACWY",
    "MENINGOCOCCAL DISEASE, UNKNOWN SEROGROUP",
    "MPOX",
    "MUMPS",
    "NOVEL INFLUENZA A VIRUS INFECTIONS",
    "NOVEL INFLUENZA A VIRUS INFECTIONS, CONFIRMED",
    "NOVEL INFLUENZA A VIRUS INFECTIONS, PROBABLE",
    "OROPOUCHE, NON-CONGENITAL",
    "PERTUSSIS",
    "PLAGUE",
    "POLIOMYELITIS, PARALYTIC",
    "POLIOVIRUS INFECTION, NONPARALYTIC",
    "PSITTACOSIS",
    "Q FEVER, ACUTE",
    "Q FEVER, CHRONIC",
    "RABIES, ANIMAL",
    "RABIES, HUMAN",
    "RUBELLA",
    "RUBELLA, CONGENITAL SYNDROME",
    "SALMONELLA PARATYPHI INFECTION",
    "SALMONELLA TYPHI INFECTION",
    "SALMONELLOSIS (EXCLUDING SALMONELLA TYPHI INFECTION AND SALMONELLA PARATYPHI INFECTION)",
    "SEVERE ACUTE RESPIRATORY SYNDROME-ASSOCIATED CORONAVIRUS DISEASE",
    "SHIGA TOXIN-PRODUCING ESCHERICHIA COLI (STEC)",
    "SHIGELLOSIS",
    "SMALLPOX",
    "STREPTOCOCCAL TOXIC SHOCK SYNDROME",
    "SYPHILIS, CONGENITAL",
    "SYPHILIS, PRIMARY AND SECONDARY",
    "TETANUS",
    "TOXIC SHOCK SYNDROME (OTHER THAN STREPTOCOCCAL)",
    "TRICHINELLOSIS",
    "TUBERCULOSIS",
    "TULAREMIA",
    "VANCOMYCIN-INTERMEDIATE STAPHYLOCOCCUS AUREUS",
    "VANCOMYCIN-RESISTANT STAPHYLOCOCCUS AUREUS",
    "VARICELLA DISEASE",
    "VARICELLA MORBIDITY",
    "VIBRIOSIS (ANY SPECIES OF THE FAMILY VIBRIONACEAE, OTHER THAN TOXIGENIC VIBRIO CHOLERAE O1 OR O139), CONFIRMED",
    "VIBRIOSIS (ANY SPECIES OF THE FAMILY VIBRIONACEAE, OTHER THAN TOXIGENIC VIBRIO CHOLERAE O1 OR O139), PROBABLE",
    "VIRAL HEMORRHAGIC FEVERS, CHAPARE VIRUS",
    "VIRAL HEMORRHAGIC FEVERS, CRIMEAN-CONGO HEMORRHAGIC FEVER VIRUS",
    "VIRAL HEMORRHAGIC FEVERS, EBOLA VIRUS",
    "VIRAL HEMORRHAGIC FEVERS, GUANARITO VIRUS",
    "VIRAL HEMORRHAGIC FEVERS, JUNIN VIRUS",
    "VIRAL HEMORRHAGIC FEVERS, LASSA VIRUS",
    "VIRAL HEMORRHAGIC FEVERS, LUJO VIRUS",
    "VIRAL HEMORRHAGIC FEVERS, MACHUPO VIRUS",
    "VIRAL HEMORRHAGIC FEVERS, MARBURG VIRUS",
    "VIRAL HEMORRHAGIC FEVERS, RIFT VALLEY FEVER VIRUS",
    "VIRAL HEMORRHAGIC FEVERS, SABIA VIRUS",
    "YELLOW FEVER",
    "ZIKA VIRUS DISEASE, NON-CONGENITAL",
]

# ---------------------------------------------------------------------------
# FIXED VALUES: seed `us_holidays` (year, week, holiday_name), 35 rows.
# ---------------------------------------------------------------------------
US_HOLIDAYS: list[tuple[int, int, str]] = [
    (2022, 1, "New Year's Day"),
    (2022, 16, "Easter"),
    (2022, 21, "Memorial Day"),
    (2022, 26, "Independence Day"),
    (2022, 38, "Labor Day"),
    (2022, 47, "Thanksgiving"),
    (2022, 52, "Christmas"),
    (2023, 1, "New Year's Day"),
    (2023, 16, "Easter"),
    (2023, 21, "Memorial Day"),
    (2023, 26, "Independence Day"),
    (2023, 38, "Labor Day"),
    (2023, 47, "Thanksgiving"),
    (2023, 52, "Christmas"),
    (2024, 1, "New Year's Day"),
    (2024, 13, "Easter"),
    (2024, 21, "Memorial Day"),
    (2024, 26, "Independence Day"),
    (2024, 36, "Labor Day"),
    (2024, 47, "Thanksgiving"),
    (2024, 52, "Christmas"),
    (2025, 1, "New Year's Day"),
    (2025, 16, "Easter"),
    (2025, 21, "Memorial Day"),
    (2025, 26, "Independence Day"),
    (2025, 36, "Labor Day"),
    (2025, 47, "Thanksgiving"),
    (2025, 52, "Christmas"),
    (2026, 1, "New Year's Day"),
    (2026, 13, "Easter"),
    (2026, 21, "Memorial Day"),
    (2026, 26, "Independence Day"),
    (2026, 36, "Labor Day"),
    (2026, 47, "Thanksgiving"),
    (2026, 52, "Christmas"),
]

# ---------------------------------------------------------------------------
# FIXED VALUES (ours, for the dashboard measures): STI short names.
# ---------------------------------------------------------------------------
STI_SHORT_NAMES: list[str] = [
    "CHANCROID",
    "CHLAMYDIA TRACHOMATIS INFECTION",
    "GONORRHEA",
    "SYPHILIS",
]

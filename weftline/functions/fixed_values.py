"""Values that results depend on, stated as they are."""

# Titles and suffixes that names lose.
TITLES = ["Dr.", "Dr", "MD", "PhD", "DO", "PA", "NP", "RN"]
SUFFIXES = ["Jr.", "Sr.", "II", "III", "IV"]

# Words that say nothing about which institution is meant.
AFFILIATION_STOP_WORDS = ["hospital", "medical", "center", "clinic", "health", "system", "university", "of", "the", "and"]

# State names and codes.
STATES = {
    "alabama": "AL", "alaska": "AK", "arizona": "AZ", "arkansas": "AR", "california": "CA", "colorado": "CO", "connecticut": "CT",
    "delaware": "DE", "florida": "FL", "georgia": "GA", "hawaii": "HI", "idaho": "ID", "illinois": "IL", "indiana": "IN", "iowa": "IA",
    "kansas": "KS", "kentucky": "KY", "louisiana": "LA", "maine": "ME", "maryland": "MD", "massachusetts": "MA", "michigan": "MI",
    "minnesota": "MN", "mississippi": "MS", "missouri": "MO", "montana": "MT", "nebraska": "NE", "nevada": "NV", "new hampshire": "NH",
    "new jersey": "NJ", "new mexico": "NM", "new york": "NY", "north carolina": "NC", "north dakota": "ND", "ohio": "OH", "oklahoma": "OK",
    "oregon": "OR", "pennsylvania": "PA", "rhode island": "RI", "south carolina": "SC", "south dakota": "SD", "tennessee": "TN", "texas": "TX",
    "utah": "UT", "vermont": "VT", "virginia": "VA", "washington": "WA", "west virginia": "WV", "wisconsin": "WI", "wyoming": "WY",
    "district of columbia": "DC",
}

# Street directions and types.
DIRECTIONS = {"north": "N", "south": "S", "east": "E", "west": "W", "northeast": "NE", "northwest": "NW", "southeast": "SE", "southwest": "SW"}
STREET_TYPES = {
    "street": "St", "avenue": "Ave", "boulevard": "Blvd", "drive": "Dr", "lane": "Ln", "road": "Rd",
    "court": "Ct", "place": "Pl", "square": "Sq", "terrace": "Ter", "highway": "Hwy", "circle": "Cir",
}

# Accepted sources and the patterns and limits of the validation rules.
SOURCES = ["EHR", "HMO", "Medicaid", "Medicare", "Public Registry", "Insurance"]
EMAIL_RULE = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"
PHONE_RULE = r"^[\d\-\(\)\s\+]+$"
NAME_LENGTH = (2, 100)
TABLE_ROWS = (1, 1_000_000)
REQUIRED = ["provider_id", "raw_name", "first_name", "last_name", "affiliation", "address", "phone", "email", "source"]

# The affiliation dictionary; of rows with one variant the last counts.
AFFILIATIONS = [
    ("Johns Hopkins Hospital", "johns hopkins hospital"), ("Johns Hopkins Hospital", "johns hopkins"), ("Johns Hopkins Hospital", "hopkins hospital"), ("Johns Hopkins Hospital", "john hopkins medical center"),
    ("Mayo Clinic", "Mayo Clinic"), ("Mayo Clinic", "Mayo Clinic Rochester"), ("Mayo Clinic", "Mayo Clinic Arizona"), ("Mayo Clinic", "Mayo Clinic Florida"),
    ("Massachusetts General Hospital", "Massachusetts General Hospital"), ("Massachusetts General Hospital", "Mass General"), ("Massachusetts General Hospital", "MGH"), ("Massachusetts General Hospital", "Mass General Hospital"),
    ("UCSF Medical Center", "UCSF Medical Center"), ("UCSF Medical Center", "University of California San Francisco Medical Center"), ("UCSF Medical Center", "UCSF"),
    ("Mount Sinai Hospital", "Mount Sinai Hospital"), ("Mount Sinai Hospital", "Mount Sinai"), ("Mount Sinai Hospital", "Icahn School of Medicine"),
    ("New York-Presbyterian Hospital", "New York-Presbyterian Hospital"), ("New York-Presbyterian Hospital", "NYP"), ("New York-Presbyterian Hospital", "New York Presbyterian"),
    ("Northwestern Memorial Hospital", "Northwestern Memorial Hospital"), ("Northwestern Memorial Hospital", "Northwestern Hospital"), ("Northwestern Memorial Hospital", "Northwestern"),
    ("Stanford Health Care", "Stanford Health Care"), ("Stanford Health Care", "Stanford Hospital"), ("Stanford Health Care", "Stanford Medical Center"),
    ("Brigham and Women's Hospital", "Brigham and Women's Hospital"), ("Brigham and Women's Hospital", "Brigham"), ("Brigham and Women's Hospital", "BWH"),
    ("Beth Israel Deaconess Medical Center", "Beth Israel Deaconess Medical Center"), ("Beth Israel Deaconess Medical Center", "BIDMC"), ("Beth Israel Deaconess Medical Center", "Beth Israel"),
    ("Duke University Hospital", "Duke University Hospital"), ("Duke University Hospital", "Duke Hospital"), ("Duke University Hospital", "Duke Medical Center"),
    ("Vanderbilt University Medical Center", "Vanderbilt University Medical Center"), ("Vanderbilt University Medical Center", "Vanderbilt"), ("Vanderbilt University Medical Center", "VUMC"),
    ("Cleveland Clinic", "Cleveland Clinic"), ("Cleveland Clinic", "Cleveland Clinic Foundation"), ("Cleveland Clinic", "CCF"),
    ("University of Pennsylvania Health System", "University of Pennsylvania Health System"), ("University of Pennsylvania Health System", "UPenn Health System"), ("University of Pennsylvania Health System", "Penn Medicine"),
    ("Johns Hopkins Health System", "Johns Hopkins Health System"), ("Johns Hopkins Health System", "JHHS"), ("Johns Hopkins Health System", "Johns Hopkins Medicine"),
    ("Mayo Clinic Health System", "Mayo Clinic Health System"), ("Mayo Clinic Health System", "Mayo Health System"),
    ("Kaiser Permanente", "Kaiser Permanente"), ("Kaiser Permanente", "Kaiser"), ("Kaiser Permanente", "Kaiser Foundation Hospitals"),
    ("HCA Healthcare", "HCA Healthcare"), ("HCA Healthcare", "HCA"), ("HCA Healthcare", "Hospital Corporation of America"),
    ("Ascension", "Ascension"), ("Ascension", "Ascension Health"), ("Ascension", "Ascension Catholic"),
    ("CommonSpirit Health", "CommonSpirit Health"), ("CommonSpirit Health", "Dignity Health"), ("CommonSpirit Health", "Catholic Health Initiatives"),
    ("Tenet Healthcare", "Tenet Healthcare"), ("Tenet Healthcare", "Tenet"), ("Tenet Healthcare", "Tenet Health"),
    ("Community Health Systems", "Community Health Systems"), ("Community Health Systems", "CHS"), ("Community Health Systems", "Community Health"),
    ("Hospital Corporation of America", "Hospital Corporation of America"), ("Hospital Corporation of America", "HCA"), ("Hospital Corporation of America", "HCA Healthcare"),
]

"""Names, types and patterns that are given by the data set."""

# Visit record columns as (source name, table name, kind). Dates, whole numbers and
# the port text are converted; the other columns stay as they are stored ("double" and "string" are
# what the source has as a rule).
VISIT_FIELDS = [
    ("cicid", "citizen_id", "double"),
    ("i94yr", "year", "int"),
    ("i94mon", "month", "int"),
    ("i94port", "airport_code", "string"),
    ("i94addr", "state_id", "string"),
    ("arrdate", "arrival_date", "date"),
    ("depdate", "departure_date", "date"),
    ("i94mode", "travel_mode_id", "double"),
    ("i94visa", "visa_category_id", "double"),
    ("visatype", "visa_type", "string"),
    ("i94cit", "citizen_country_id", "double"),
    ("i94res", "residence_country_id", "double"),
    ("biryear", "birth_year", "double"),
    ("gender", "gender", "string"),
    ("insnum", "ins_num", "string"),
    ("airline", "airline", "string"),
    ("admnum", "admin_num", "double"),
    ("fltno", "flight_number", "string"),
]

YEAR_FIELD, MONTH_FIELD, PORT_FIELD = "i94yr", "i94mon", "i94port"

# City demography file, by position. The header is skipped.
DEMOGRAPHY_SCHEMA = """
    city string, state string, median_age double, male_population int,
    female_population int, total_population int, number_of_veterans int,
    foreign_born int, average_household_size double, state_id string, race string
"""

# Section names in the label files.
COUNTRY_SECTION = "i94cntyl"
PORT_SECTION = "$i94prtl"
MODE_SECTION = "i94model"
STATE_SECTION = "i94addrl"
VISA_SECTION = "I94VISA"
LABEL_SECTIONS = [COUNTRY_SECTION, PORT_SECTION, MODE_SECTION, STATE_SECTION, VISA_SECTION]

# Country names that stand for "no country", and what replaces them.
INVALID_COUNTRY = "^No Country.*|INVALID.*|Collapsed.*"
INVALID_COUNTRY_NAME = "NA"

# Fixed value: state code for "all other codes".
OTHER_STATE_CODE = "99"

# Table names in the lake.
VISITS = "immigration_facts"
DEMOGRAPHY = "dim_city_demography"
MODES = "dim_travel_mode"
COUNTRIES = "dim_country"
VISAS = "dim_visa_category"
STATES = "dim_us_states"
PORTS = "dim_airport_codes"

#: Sections whose codes are whole numbers, and the tables they become.
NUMBERED_SECTIONS = {MODE_SECTION: MODES, COUNTRY_SECTION: COUNTRIES, VISA_SECTION: VISAS}

VISIT_PARTITIONS = ["year", "month", "airport_code"]
VISIT_PARTITION_KINDS = ["int", "int", "string"]
VISIT_MONTHS = "immigration_months"
VISIT_COUNTS = "immigration_counts"

# Primary key of each dimension.
DIMENSION_KEYS = {
    DEMOGRAPHY: ["city", "state_id"],
    MODES: ["travel_mode_id"],
    COUNTRIES: ["country_id"],
    VISAS: ["visa_category_id"],
    STATES: ["us_state_id"],
    PORTS: ["airport_code"],
}

# Foreign keys of the visits table: column -> (dimension, key column).
VISIT_REFERENCES = {
    "airport_code": (PORTS, "airport_code"),
    "state_id": (STATES, "us_state_id"),
    "travel_mode_id": (MODES, "travel_mode_id"),
    "visa_category_id": (VISAS, "visa_category_id"),
    "citizen_country_id": (COUNTRIES, "country_id"),
    "residence_country_id": (COUNTRIES, "country_id"),
}

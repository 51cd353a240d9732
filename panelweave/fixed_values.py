"""Survey codes, classifications, variable lists and labels.

Everything here is a constant of the survey or of the published study design;
results depend on these values being exactly what they are.
"""

# Codes that mark a missing answer.
MISSING_CODES = (-8, -7, -6, -5, -4, -3, -2, -1)

# Datasets keyed by household and year; all others by person and year.
HOUSEHOLD_DATASETS = ("hl", "hgen")

# Study years.
STUDY_YEARS = (2009, 2010, 2011, 2012, 2013, 2014)

# Outcomes, and the recodes applied after the merge ({column: {old: new}}).
WILLING = "plb0097"
ACTUAL = "plb0095_v1"
RECODES = {
    "plb0095_v1": {2: 0},
    "plb0097": {2: 0},
    "sex": {1: 0, 2: 1},
}

# Partner codes that count as living with a partner.
PARTNER_CODES = (1, 2, 3, 4)

# Regressors in reporting order, and those that vary within a person.
CONTROLS = (
    "age", "sex", "migback_direct", "migback_indirect", "has_partner",
    "pgisced97", "log_income", "has_children", "sqm_per_head",
    "work_hrs_100", "plb0193_h", "plh0173",
)
TIME_VARYING = (
    "age", "has_partner", "pgisced97", "log_income", "has_children",
    "sqm_per_head", "work_hrs_100", "plb0193_h", "plh0173",
)

# Report groups and labels of the regressors.
TERM_GROUPS = (
    ("Demographic Characteristics", ("age", "sex", "migback_direct", "migback_indirect", "has_partner")),
    ("Socioeconomic Determinants", ("pgisced97", "log_income", "has_children", "sqm_per_head")),
    ("Labour Determinants", ("work_hrs_100", "plb0193_h", "plh0173")),
)
TERM_LABELS = {
    "plb0097": "WFH Preference (stated)",
    "age": "Age",
    "sex": "Female",
    "migback_direct": "Direct Migr. Background",
    "migback_indirect": "Indirect Migr. Background",
    "has_partner": "Has Partner in HH",
    "pgisced97": "Education (ISCED-97)",
    "log_income": "HH Post-Gov. Income (log)",
    "has_children": "Has Children in HH",
    "sqm_per_head": "Living Space (sqm/person)",
    "work_hrs_100": "Annual Work Hours (per 100h)",
    "plb0193_h": "Works Overtime",
    "plh0173": "Work Satisfaction",
}

# 15 industry sectors with their codes in classification revisions 1 and 2.
SECTORS = (
    (1, "Agriculture, Forestry & Fishing", (1, 2, 5), (1, 2, 3)),
    (2, "Mining & Quarrying", (10, 11, 12, 13, 14), (5, 6, 7, 8, 9)),
    (3, "Manufacturing",
     (15, 16, 17, 18, 19, 20, 21, 22, 23, 24, 25, 26, 27, 28, 29, 30, 31, 32, 33, 34, 35, 36, 37),
     (10, 11, 12, 13, 14, 15, 16, 17, 18, 19, 20, 21, 22, 23, 24, 25, 26, 27, 28, 29, 30, 31, 32, 33)),
    (4, "Utilities & Waste", (40, 41), (35, 36, 37, 38, 39)),
    (5, "Construction", (45,), (41, 42, 43)),
    (6, "Trade & Hospitality", (50, 51, 52, 55), (45, 46, 47, 55, 56)),
    (7, "Transport & Logistics", (60, 61, 62, 63), (49, 50, 51, 52, 53)),
    (8, "Information & Communication", (64, 72), (58, 59, 60, 61, 62, 63)),
    (9, "Finance & Insurance", (65, 66, 67), (64, 65, 66)),
    (10, "Professional & Business Services",
     (70, 71, 73, 74),
     (68, 69, 70, 71, 72, 73, 74, 75, 77, 78, 79, 80, 81, 82)),
    (11, "Public Administration", (75,), (84,)),
    (12, "Education", (80,), (85,)),
    (13, "Health & Social Work", (85,), (86, 87, 88)),
    (14, "Other Services", (90, 91, 92, 93, 95, 96, 97), (90, 91, 92, 93, 94, 95, 96, 97, 98)),
    (15, "Extra-territorial", (99,), (99,)),
)

# Federal states (code, name, short name).
STATES = (
    (1, "Baden-Württemberg", "BW"),
    (2, "Bayern", "BY"),
    (3, "Berlin", "BE"),
    (4, "Brandenburg", "BB"),
    (5, "Bremen", "HB"),
    (6, "Hamburg", "HH"),
    (7, "Hessen", "HE"),
    (8, "Mecklenburg-Vorpommern", "MV"),
    (9, "Niedersachsen", "NI"),
    (10, "Nordrhein-Westfalen", "NRW"),
    (11, "Rheinland-Pfalz", "RP"),
    (12, "Saarland", "SL"),
    (13, "Sachsen", "SN"),
    (14, "Sachsen-Anhalt", "ST"),
    (15, "Schleswig-Holstein", "SH"),
    (16, "Thüringen", "TH"),
)

# Variable registry, per report panel
# (panel key, panel label, [(name, dataset, label, scale, type, note)]).
VARIABLES = (
    ("identifiers", "Identifiers", (
        ("pid", "ppathl", "Person ID", "UID", "id", ""),
        ("hid", "ppathl", "Household ID", "UID", "id", ""),
    )),
    ("outcome_primary", "Primary Outcome", (
        ("plb0097", "pl", "Willing to WFH", "0=No, 1=Yes, 3=Not possible", "categorical", ""),
        ("plb0095_v1", "pl", "Actually WFH", "0=No, 1=Yes", "categorical", ""),
    )),
    ("controls_demo", "Demographic Characteristics", (
        ("age", "derived", "Age", "years", "continuous", ""),
        ("sex", "ppathl", "Gender", "1=M, 2=F", "categorical", ""),
        ("partner", "ppathl", "Status Of Partnership", "1--5", "categorical", ""),
        ("migback", "ppathl", "Migr. Background", "1=None, 2=Direct, 3=Indirect", "categorical", ""),
        ("d11107", "pequiv", "Num. children in HH", "count", "continuous", ""),
    )),
    ("controls_socio", "Socioeconomic Determinants", (
        ("i11102", "pequiv", "HH Post-Gov Income", "EUR", "continuous", ""),
        ("pgisced97", "pgen", "Educ. (ISCED-97)", "1--6", "continuous", ""),
        ("l11101", "pequiv", "Federal State", "1--16", "categorical", ""),
        ("sqm_per_head", "derived", "Living space per person", "sqm/person", "continuous", ""),
    )),
    ("controls_other", "Labour Determinants", (
        ("plh0173", "pl", "Work satisfaction", "0--10", "continuous", ""),
        ("pglfs", "pgen", "LF Status", "1--13", "categorical", ""),
        ("pgemplst", "pgen", "Employment Status",
         "1=Full-time, 2=Part-time, 3=Vocational, 4=Irregular, 5=Not employed", "categorical", ""),
        ("e11101", "pequiv", "Annual work hrs", "hours", "continuous", ""),
        ("plb0193_h", "pl", "Overtime", "0/1", "continuous", ""),
        ("sector", "derived", "Industry Sector", "1--15", "categorical",
         "Comes from two industry codes: revision 1, then revision 2."),
    )),
)

# Derived columns (name, label, scale, [(dataset, source column)]).
DERIVED = (
    ("age", "Age", "years", (("ppathl", "gebjahr"),)),
    ("sqm_per_head", "Living space pp.", "sqm/person", (("hl", "hlf0019_h"), ("pequiv", "d11106"))),
    ("sector", "Industry Sector", "1--15", (("pgen", "pgnace"), ("pgen", "pgnace2"))),
)

# Questions asked in several versions
# (name, dataset, label, [(source column, {code: value})] in order of preference).
HARMONISED = (
    ("plb0193_h", "pl", "Works overtime", (
        ("plb0193_v1", {1: 1, 2: 0}),
        ("plb0193_v2", {1: 1, 2: 0}),
    )),
)

# Files of the datasets a variable is looked for first.
KEY_FILES = {
    "pl": "pl.csv",
    "pgen": "pgen.csv",
    "ppathl": "ppathl.csv",
    "hgen": "hgen.csv",
    "hl": "hl.csv",
    "pequiv": "pequiv.csv",
    "pkal": "pkal.csv",
    "health": "health.csv",
    "regionl": "regionl.csv",
}

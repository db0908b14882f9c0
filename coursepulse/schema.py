"""Table registry, fixed schemas, keys and fixed value lists of the cohort data model.

Time in every table is an integer day offset from the course start (negative before it).
"""

from __future__ import annotations

from pyspark.sql import types as T

# Entity keys.
K2 = ["code_module", "code_presentation"]
K3 = ["code_module", "code_presentation", "id_student"]

# Table name -> key columns (uniqueness is checked by operators.checks.assert_unique_keys).
KEYS: dict[str, list[str]] = {
    "student_assessment": ["id_assessment", "id_student"],
    "student_info": K3,
    "courses": K2,
    "vle": ["id_site", "code_module", "code_presentation"],
    "student_registration": K3,
    "assessments": ["code_module", "code_presentation", "id_assessment"],
}

TABLES = (
    "courses",
    "assessments",
    "student_info",
    "student_registration",
    "student_assessment",
    "vle",
    "student_vle",
)

# CSV file name of each table in the public data set.
CSV_FILES = {
    "courses": "courses.csv",
    "assessments": "assessments.csv",
    "student_info": "studentInfo.csv",
    "student_registration": "studentRegistration.csv",
    "student_assessment": "studentAssessment.csv",
    "vle": "vle.csv",
    "student_vle": "studentVle.csv",
}

S, L, D = T.StringType(), T.LongType(), T.DoubleType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


SCHEMAS: dict[str, T.StructType] = {
    "courses": _struct(("code_module", S), ("code_presentation", S), ("module_presentation_length", L)),
    "assessments": _struct(
        ("code_module", S), ("code_presentation", S), ("id_assessment", L),
        ("assessment_type", S), ("date", L), ("weight", D),
    ),
    "student_info": _struct(
        ("code_module", S), ("code_presentation", S), ("id_student", L), ("gender", S), ("region", S),
        ("highest_education", S), ("imd_band", S), ("age_band", S), ("num_of_prev_attempts", L),
        ("studied_credits", L), ("disability", S), ("final_result", S),
    ),
    "student_registration": _struct(
        ("code_module", S), ("code_presentation", S), ("id_student", L),
        ("date_registration", L), ("date_unregistration", L),
    ),
    "student_assessment": _struct(
        ("id_assessment", L), ("id_student", L), ("date_submitted", L), ("is_banked", L), ("score", D),
    ),
    "vle": _struct(
        ("id_site", L), ("code_module", S), ("code_presentation", S), ("activity_type", S),
        ("week_from", L), ("week_to", L),
    ),
    "student_vle": _struct(
        ("code_module", S), ("code_presentation", S), ("id_student", L), ("id_site", L),
        ("date", L), ("sum_click", L),
    ),
}

# --- fixed values: must equal the reference's lists, in their order --------------------------------

# Activity types of the click log, in the reference's order.
ACTIVITIES = [
    "forumng", "subpage", "oucontent", "homepage", "quiz",
    "resource", "url", "ouwiki", "externalquiz", "page",
    "oucollaborate", "questionnaire", "ouelluminate",
    "glossary", "dualpane", "dataplus", "folder",
    "sharedsubpage", "repeatactivity",
]

# Orders of the ordinal columns of student_info ('10-20' has no '%' in the reference).
ORDINAL_ORDERS: dict[tuple[str, str], list[str]] = {
    ("student_info", "highest_education"): [
        "No Formal quals", "Lower Than A Level", "A Level or Equivalent",
        "HE Qualification", "Post Graduate Qualification",
    ],
    ("student_info", "imd_band"): [
        "0-10%", "10-20", "20-30%", "30-40%", "40-50%", "50-60%", "60-70%", "70-80%", "80-90%", "90-100%",
    ],
    ("student_info", "age_band"): ["0-35", "35-55", "55<="],
}

# Predefined feature batches.
NUMERIC_BATCH = [
    ("student_info", "num_of_prev_attempts"),
    ("student_info", "studied_credits"),
    ("student_registration", "date_registration"),
]
CATEGORICAL_BATCH = [
    ("student_info", "gender"),
    ("student_info", "region"),
    ("student_info", "disability"),
]
ORDINAL_BATCH = [
    ("student_info", "highest_education"),
    ("student_info", "imd_band"),
    ("student_info", "age_band"),
]

# Default training terms; the complement is the test set.
TRAIN_TERMS = ["2013B", "2013J", "2014B"]
TEST_TERMS = ["2014J"]

# Outcome labels and the fixed outcome maps used by the legacy flows.
OUTCOMES = ["Pass", "Withdrawn", "Fail", "Distinction"]
FAIL_VS_PASS = {"Distinction": 0.0, "Pass": 0.0, "Fail": 1.0, "Withdrawn": None}
THREE_LEVEL = {"Distinction": 2, "Pass": 2, "Fail": 1, "Withdrawn": 0}
OUTCOME_GROUP = {"Pass": "Pass", "Withdrawn": "Withdrawn", "Fail": "Fail", "Distinction": "Pass"}
PASS_FAIL_WITHDRAWN = {"Pass": 0, "Distinction": 0, "Fail": 1, "Withdrawn": 2}

# Default response column name (spelled as in the reference).
RESPONSE = "responce"

# Time-regularity metric names; the output columns get this prefix.
TIME_METRICS = ["pwd", "ws1", "ws2", "ws3", "fwd"]
REGULARITY_PREFIX = "regularity_indicator_"

SEGMENT_DAYS = 30

"""Code lists and text rules of the enrolment register, as Column expressions.

Everything under "Fixed values" must equal the register's published code
lists for the results to be right; it is data, stated as plain text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fixreg.functions.exprs import col_, recode, whole_word

# ---------------------------------------------------------------------------
# Fixed values
# ---------------------------------------------------------------------------

# Prior-education description → short label.  Ordered: the first whole-word
# match (on the lower-cased text) wins; no match → OTHER_PRIOR_EDUCATION.
PRIOR_EDUCATION_RULES = [
    ("mbo", "mbo"),
    ("vwo", "vwo"),
    ("havo", "havo"),
    ("hbo-p", "hbo-p"),
    ("hbo-ba", "hbo-ba"),
    ("hbo-ad", "hbo-ad"),
    ("hbo-vo/ma", "hbo-master"),
    ("hbo-pim", "hbo-master"),
    ("wo-p", "wo-p"),
    ("wo-ba", "wo-ba"),
    ("wo-on/ma", "wo-master"),
    ("wo-pim", "wo-master"),
    ("wo-vo/ma/bf", "wo-master"),
]
OTHER_PRIOR_EDUCATION = "overig"

# Prior-education code → subject profile (havo 002xx, vwo 004xx).
PROFILE_BY_CODE = {
    "00200": "ONB",
    "00201": "ALG",
    "00202": "CM",
    "00203": "EM",
    "00204": "EM & CM",
    "00205": "NG",
    "00206": "NG & CM",
    "00207": "NG & EM",
    "00208": "NT",
    "00209": "NT & CM",
    "00210": "NT & EM",
    "00211": "NT & NG",
    "00400": "ONG",
    "00401": "ALG",
    "00402": "CM",
    "00403": "EM",
    "00404": "EM & CM",
    "00405": "NG",
    "00406": "NG & CM",
    "00407": "NG & EM",
    "00408": "NT",
    "00409": "NT & CM",
    "00410": "NT & EM",
    "00411": "NT & NG",
}

# Programme-register sector code → sector name.
SECTOR_BY_CODE = {
    "1": "onderwijs",
    "2": "landbouw en natuurlijke omgeving",
    "3": "natuur",
    "4": "techniek",
    "5": "gezondheidszorg",
    "6": "economie",
    "7": "recht",
    "8": "gedrag en maatschappij",
    "9": "taal en cultuur",
    "0": "sectoroverstijgend",
}

# Phase of the diploma → kind of diploma.
DIPLOMA_KIND_BY_PHASE = {
    "D": "propedeuse",
    "A": "associate degree",
    "B": "bachelor",
    "M": "master",
    "Q": "post-initiele master",
}

# Programme phase code → programme type.
PROGRAMME_TYPE_BY_PHASE = {
    "O": "oude stijl (toegestaan t/m studiejaar 1992-1993)",
    "P": "propedeuse",
    "1": "1e fase (WO); hoofdfase (HBO) (toegestaan t/m studiejaar 92-93)",
    "2": "2e fase (toegestaan t/m studiejaar 1996-1997)",
    "I": "initiële opleiding (toegestaan vanaf studiejaar 1993-1994)",
    "V": "vervolgopleiding (toegestaan vanaf studiejaar 1993-1994)",
    "K": "kandidaatsfase",
    "D": "propedeuse bachelor",
    "B": "bachelor",
    "M": "master",
    "A": "associate degree",
    "T": "tussentijds doctoraal",
    "Q": "post-initiële master",
}

# Higher-education type inside the kind → programme level used in cohorts.
LEVEL_BY_HE_TYPE = {"ba": "bachelor", "ma": "master", "ad": "associate degree"}

# Cohort definition flag → cohort type.
COHORT_TYPE_BY_FLAG = {"Ja": "EersteKeerHO", "Nee": "EersteKeerHsl"}

UNKNOWN = "onbekend"

# ---------------------------------------------------------------------------
# Expressions
# ---------------------------------------------------------------------------


def classify_prior_education(c: str | Column) -> Column:
    """Short label of a prior-education description (E1); null → ``overig``."""
    text = F.lower(col_(c))
    out = None
    for word, lab in PRIOR_EDUCATION_RULES:
        cond = whole_word(text, word)
        out = F.when(cond, F.lit(lab)) if out is None else out.when(cond, F.lit(lab))
    return out.otherwise(F.lit(OTHER_PRIOR_EDUCATION))


def profile_of(code: str | Column) -> Column:
    """Subject profile of a prior-education code (E2); unmapped → null."""
    return recode(code, PROFILE_BY_CODE, keep_unmapped=False)


def sector_of(code: str | Column) -> Column:
    """Sector name (E7): unmapped kept, missing → ``onbekend``."""
    return recode(col_(code).cast("string"), SECTOR_BY_CODE, keep_unmapped=True, default=UNKNOWN)


def diploma_kind_of(phase: str | Column) -> Column:
    """Diploma kind (E8): unmapped kept, missing stays missing."""
    return recode(phase, DIPLOMA_KIND_BY_PHASE, keep_unmapped=True)


def programme_type_of(phase: str | Column) -> Column:
    """Programme type (E10): unmapped kept, missing → ``onbekend``."""
    return recode(phase, PROGRAMME_TYPE_BY_PHASE, keep_unmapped=True, default=UNKNOWN)

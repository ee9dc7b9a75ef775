"""Relational operators: first per key, checked joins, unpivot, privacy."""

from fixreg.operators.first_per_key import first_per_key
from fixreg.operators.joins import (
    CheckFailed,
    anti_join,
    assert_unique,
    duplicate_keys,
    lookup_join,
    member_flag,
    require_columns,
    require_not_null,
)
from fixreg.operators.privacy import (
    add_local_id,
    blank_columns,
    crosswalk,
    global_rank,
    hash_id,
    pseudonymise,
    replace_id,
)
from fixreg.operators.profile import merge_profiles, profile_columns, profile_estimates
from fixreg.operators.reshape import unpivot_non_null

__all__ = [
    "CheckFailed",
    "add_local_id",
    "anti_join",
    "assert_unique",
    "blank_columns",
    "crosswalk",
    "duplicate_keys",
    "first_per_key",
    "global_rank",
    "hash_id",
    "lookup_join",
    "member_flag",
    "merge_profiles",
    "profile_columns",
    "profile_estimates",
    "pseudonymise",
    "replace_id",
    "require_columns",
    "require_not_null",
    "unpivot_non_null",
]

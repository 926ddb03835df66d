"""The profile columns and the golden record's fields."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: List fields that are carried on unread, in the golden record's names.
BAGS = """datesOfBirthParsed aliases addresses notes contactEntries identifiers evidences pepByAssociationEntries relEntries
rreEntries poiEntries insEntries ddEntries individualLinks businessLinks griEntries""".split()
#: Fields with a current and a former list.
DATED_BAGS = ["sanEntries", "pepEntries"]
#: The fields of a golden record's data, in the order of its serialisation.
DATA_FIELDS = """qrCode resourceUri resourceId firstName fullName middleName lastName gender provider provider_version isDeleted
isDeceased nationality datesOfBirthParsed nameAliases aliases datesOfBirthIso datesOfDeathIso nationalitiesIsoCodes addresses
profileImages notes contactEntries identifiers evidences sanEntries pepEntries pepByAssociationEntries relEntries rreEntries
poiEntries insEntries ddEntries individualLinks businessLinks griEntries""".split()


def bag_columns() -> list[str]:
    """Columns of canonical JSON texts: one per list field, two per dated field."""
    return [f"bag_{b}" for b in BAGS] + [f"bag_{b}_{part}" for b in DATED_BAGS for part in ("current", "former")]


#: Profile columns other than bags, with their types.
PROFILE = {
    "idx": "long",
    "full_name": "string",
    "first_name": "string",
    "middle_name": "string",
    "last_name": "string",
    "gender": "string",
    "is_deceased": "boolean",
    "is_deleted": "boolean",
    "name_aliases": "array<string>",
    "dobs": "array<string>",
    "dods": "array<string>",
    "nats": "array<string>",
    "images": "array<string>",
    "datasets": "array<string>",
}


def complete(profiles: DataFrame) -> DataFrame:
    """``profiles`` with all profile columns; missing ones are null, flags false, lists empty."""
    kinds = PROFILE | {b: "array<string>" for b in bag_columns()}
    cols = []
    for name, kind in kinds.items():
        have = F.col(name).cast(kind) if name in profiles.columns else F.lit(None).cast(kind)
        if kind == "boolean":
            have = F.coalesce(have, F.lit(False))
        elif kind.startswith("array"):
            have = F.coalesce(have, F.array().cast(kind))
        cols.append(have.alias(name))
    return profiles.select(*cols)

"""The snapshot schema, and column roles for modelling, as plain lists."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Source columns by target type, in source order.
DOUBLE_COLUMNS = ["value_eur", "wage_eur", "release_clause_eur"]

INTEGER_COLUMNS = [
    "sofifa_id", "overall", "potential", "age", "height_cm", "weight_kg",
    "league_level", "club_jersey_number", "nationality_id", "nation_jersey_number",
    "weak_foot", "skill_moves", "international_reputation", "pace", "shooting",
    "passing", "dribbling", "defending", "physic", "attacking_crossing",
    "attacking_finishing", "attacking_heading_accuracy", "attacking_short_passing",
    "attacking_volleys", "skill_dribbling", "skill_curve", "skill_fk_accuracy",
    "skill_long_passing", "skill_ball_control", "movement_acceleration",
    "movement_sprint_speed", "movement_agility", "movement_reactions",
    "movement_balance", "power_shot_power", "power_jumping", "power_stamina",
    "power_strength", "power_long_shots", "mentality_aggression",
    "mentality_interceptions", "mentality_positioning", "mentality_vision",
    "mentality_penalties", "defending_marking_awareness",
    "defending_standing_tackle", "defending_sliding_tackle", "goalkeeping_diving",
    "goalkeeping_handling", "goalkeeping_kicking", "goalkeeping_positioning",
    "goalkeeping_reflexes", "goalkeeping_speed", "club_contract_valid_until",
    "club_team_id", "nation_team_id", "mentality_composure",
]

DATE_COLUMNS = ["dob", "club_joined"]

STRING_COLUMNS = [
    "player_url", "short_name", "long_name", "player_positions", "club_name",
    "league_name", "club_position", "club_loaned_from", "nationality_name",
    "nation_position", "preferred_foot", "work_rate", "body_type", "real_face",
    "player_tags", "player_traits", "player_face_url", "club_logo_url",
    "club_flag_url", "nation_logo_url", "nation_flag_url",
]

# Rating texts such as "89+3"; they stay text until the feature stages.
POSITION_COLUMNS = [
    "ls", "st", "rs", "lw", "lf", "cf", "rf", "rw",
    "lam", "cam", "ram", "lm", "lcm", "cm", "rcm", "rm",
    "lwb", "ldm", "cdm", "rdm", "rwb", "lb", "lcb", "cb", "rcb", "rb", "gk",
]

YEAR_TAG = "resource_year"
GENDER_TAG = "gender"

# Column roles for modelling.
ORDINAL_FEATURES = ["league_level", "weak_foot", "skill_moves", "international_reputation"]

NOMINAL_FEATURES = ["preferred_foot", "work_rate", "body_type", "league_name", "nationality_name"]

CONTINUOUS_FEATURES = [
    "value_eur", "wage_eur", "age", "height_cm", "weight_kg",
    "pace", "shooting", "passing", "dribbling", "defending", "physic",
    "attacking_crossing", "attacking_finishing", "attacking_heading_accuracy",
    "attacking_short_passing", "attacking_volleys",
    "skill_dribbling", "skill_curve", "skill_fk_accuracy",
    "skill_long_passing", "skill_ball_control",
    "movement_acceleration", "movement_sprint_speed", "movement_agility",
    "movement_reactions", "movement_balance",
    "power_shot_power", "power_jumping", "power_stamina", "power_strength", "power_long_shots",
    "mentality_aggression", "mentality_interceptions", "mentality_positioning",
    "mentality_vision", "mentality_penalties", "mentality_composure",
    "defending_marking_awareness", "defending_standing_tackle", "defending_sliding_tackle",
    "goalkeeping_diving", "goalkeeping_handling", "goalkeeping_kicking",
    "goalkeeping_positioning", "goalkeeping_reflexes",
]

DROPPED_COLUMNS = [
    "sofifa_id", "player_url", "short_name", "long_name",
    "player_positions", "dob", "club_team_id",
    "club_name", "club_position", "club_jersey_number",
    "club_loaned_from", "club_joined", "club_contract_valid_until",
    "nationality_id", "nation_team_id", "nation_position",
    "nation_jersey_number", "real_face", "release_clause_eur",
    "player_tags", "player_traits", "goalkeeping_speed",
    "player_face_url", "club_logo_url", "club_flag_url",
    "nation_logo_url", "nation_flag_url", "resource_year",
]

CORRELATED_FEATURES = [
    "skill_ball_control", "defending_sliding_tackle",
    "defending_marking_awareness", "defending_standing_tackle",
    "goalkeeping_positioning", "goalkeeping_kicking",
    "goalkeeping_handling", "goalkeeping_reflexes",
    "movement_sprint_speed", "potential", "value_eur", "wage_eur",
]

IMPUTED_FEATURES = [
    "league_level", "pace", "shooting",
    "passing", "dribbling", "defending", "physic", "mentality_composure",
]

LABEL = "overall"


@dataclass(frozen=True)
class CastSpec:
    """Which columns the cleaning step casts to which type. Columns in no list pass as they are."""

    doubles: list[str] = field(default_factory=list)
    integers: list[str] = field(default_factory=list)
    dates: list[str] = field(default_factory=list)
    strings: list[str] = field(default_factory=list)

    def columns(self) -> list[str]:
        return [*self.doubles, *self.integers, *self.dates, *self.strings]


SNAPSHOT_CASTS = CastSpec(DOUBLE_COLUMNS, INTEGER_COLUMNS, DATE_COLUMNS, STRING_COLUMNS)


@dataclass(frozen=True)
class FeatureRoles:
    """Column roles for the feature stages."""

    continuous: list[str]
    nominal: list[str] = field(default_factory=list)
    ordinal: list[str] = field(default_factory=list)
    modified: list[str] = field(default_factory=list)
    imputed: list[str] = field(default_factory=list)
    excluded: list[str] = field(default_factory=list)
    dropped: list[str] = field(default_factory=list)

    def numeric(self) -> list[str]:
        return [*self.continuous, *self.ordinal]

    def sources(self) -> list[str]:
        return list(dict.fromkeys([*self.continuous, *self.nominal, *self.ordinal, *self.modified]))


SNAPSHOT_ROLES = FeatureRoles(
    continuous=CONTINUOUS_FEATURES,
    nominal=NOMINAL_FEATURES,
    ordinal=ORDINAL_FEATURES,
    modified=POSITION_COLUMNS,
    imputed=IMPUTED_FEATURES,
    excluded=CORRELATED_FEATURES,
    dropped=DROPPED_COLUMNS,
)


def align(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with the columns of ``schema`` by name: reordered, missing ones null, extra ones refused."""
    extra = [c for c in df.columns if c not in schema.fieldNames()]
    if extra:
        raise ValueError(f"columns not in the target table: {extra}")
    have = {f.name: f.dataType for f in df.schema.fields}
    lacking = [f.name for f in schema.fields if f.name not in have and not f.nullable]
    if lacking:
        raise ValueError(f"required columns missing: {lacking}")
    clash = [f.name for f in schema.fields if f.name in have and have[f.name] != f.dataType]
    if clash:
        raise ValueError(f"columns of another type than the target table's: {clash}")
    return df.select(
        *[F.col(f.name) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    )

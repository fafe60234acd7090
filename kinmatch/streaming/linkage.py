"""Stream S1 records against a static, preprocessed pool.

The keyed passes are stateless stream-static equi-joins, so nothing needs a watermark; block caps are counted on the
static side once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import FULL, Profile


def keys(profile: Profile = FULL) -> dict[str, Column]:
    """Key of each pass as one string, null where it is empty."""
    part = lambda c: F.when(c != "", F.concat_ws("\x1f", "country_norm", c))
    return {"A_exact": F.when(F.col("name_clean") != "", F.col("name_clean")), "D_postal": part(F.col("postal_code")), "E_phonetic": part(F.col("name_dbl_meta_primary")), "G_prefix": part(F.col("name_prefix4"))}


def index(pool: DataFrame, profile: Profile = FULL) -> DataFrame:
    """(pass, key, cand_id) of the pool without the blocks that are over the cap."""
    caps = {"D_postal": profile.postal_cap, "E_phonetic": profile.phonetic_cap, "G_prefix": profile.prefix_cap}
    each = F.array(*(F.struct(F.lit(p).alias("pass"), k.alias("key")) for p, k in keys(profile).items()))
    rows = pool.select(F.col("entity_id").alias("cand_id"), F.inline(each)).where("key IS NOT NULL")
    limit = F.try_element_at(F.create_map(*(F.lit(x) for p in caps.items() for x in p)), F.col("pass"))
    small = rows.groupBy("pass", "key").count().where(limit.isNull() | (F.col("count") <= limit)).drop("count")
    return rows.join(small, ["pass", "key"])


def candidates(stream: DataFrame, pool_index: DataFrame, profile: Profile = FULL) -> DataFrame:
    """(s1_id, cand_id, pass) for every arriving, preprocessed record; a pair comes once for each pass that finds it."""
    each = F.array(*(F.struct(F.lit(p).alias("pass"), k.alias("key")) for p, k in keys(profile).items()))
    rows = stream.select(F.col("entity_id").alias("s1_id"), F.inline(each)).where("key IS NOT NULL")
    return rows.join(pool_index, ["pass", "key"]).select("s1_id", "cand_id", "pass")

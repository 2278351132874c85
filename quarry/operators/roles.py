"""Operators over two-role rows (a match with two players, a trip with two
ends).  The row is unpivoted once with ``inline(array(struct, struct))``
instead of being read twice and unioned."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _points(mine, theirs, win, draw, loss):
    # A NULL time compares to nothing and falls through to ``loss``.
    return F.when(mine < theirs, win).when(mine == theirs, draw).otherwise(loss)


def match_points(matches: DataFrame, roster: DataFrame, *, one_id: str = "one_id",
                 two_id: str = "two_id", one_time: str = "one_time",
                 two_time: str = "two_time", win: int = 3, draw: int = 1, loss: int = 0,
                 id_out: str = "entity_id", name_out: str = "name",
                 out: str = "num_points") -> DataFrame:
    """Points of every player and roster member: win/draw/loss by lower time.

    ``roster`` has (entity_id, name) with unique ids.  Roster members who never
    played score 0; players missing from the roster are kept with a NULL name.
    Points are summed per player first, so the full outer join only meets one
    row per player.
    """
    t1, t2 = F.col(one_time), F.col(two_time)
    sides = F.array(
        F.struct(F.col(one_id).alias("_id"), _points(t1, t2, win, draw, loss).alias("_p")),
        F.struct(F.col(two_id).alias("_id"), _points(t2, t1, win, draw, loss).alias("_p")))
    played = (matches.select(F.inline(sides))
                     .groupBy(F.col("_id").alias(id_out))
                     .agg(F.sum("_p").alias("_pts")))
    r = roster.select(F.col("entity_id").alias(id_out), F.col("name").alias(name_out))
    return (played.join(r, id_out, "full_outer")
                  .select(id_out, name_out,
                          F.coalesce(F.col("_pts"), F.lit(0)).cast("bigint").alias(out))
                  .orderBy(F.col(out).desc(), F.col(id_out).asc()))


def argmin_per_entity(matches: DataFrame, *, match_id: str = "match_id",
                      one_id: str = "one_id", two_id: str = "two_id",
                      one_time: str = "one_time", two_time: str = "two_time",
                      match_out: str = "match_id", id_out: str = "entity_id",
                      time_out: str = "best_time") -> DataFrame:
    """Each player's lowest time with its match id; ties go to the lowest match
    id; NULL times rank last (a player with only NULL times keeps one row).

    ``min(struct(time IS NULL, time, match))`` is combinable map-side, unlike
    a ranking window; the leading flag puts NULL times last.
    """
    sides = F.array(
        F.struct(F.col(match_id).alias("_m"), F.col(one_id).alias("_id"), F.col(one_time).alias("_t")),
        F.struct(F.col(match_id).alias("_m"), F.col(two_id).alias("_id"), F.col(two_time).alias("_t")))
    best = (matches.select(F.inline(sides))
                   .groupBy("_id")
                   .agg(F.min(F.struct(F.col("_t").isNull().alias("_null"),
                                       F.col("_t").alias("_t"), F.col("_m").alias("_m")))
                         .alias("_b")))
    return (best.select(F.col("_b._m").alias(match_out), F.col("_id").alias(id_out),
                        F.col("_b._t").alias(time_out))
                .orderBy(id_out))


def _role_ids(matches: DataFrame, roles) -> DataFrame:
    return (matches.select(F.explode(F.array(*[F.col(r) for r in roles])).alias("_id"))
                   .where(F.col("_id").isNotNull())
                   .distinct())


def semi_any_role(entities: DataFrame, matches: DataFrame, *, key: str, name: str,
                  roles=("one_id", "two_id"), out: str = "name") -> DataFrame:
    """Entities that appear in any role (``EXISTS ... a = x OR a = y``), one row
    per entity.  The OR becomes a union of the role columns, so the plan is a
    hash semi-join, not a nested loop."""
    ids = _role_ids(matches, roles)
    return (entities.join(ids, F.col(key) == F.col("_id"), "left_semi")
                    .select(F.col(name).alias(out))
                    .orderBy(out))


def union_distinct_roles(entities: DataFrame, matches: DataFrame, *, key: str, name: str,
                         roles=("one_id", "two_id"), out: str = "name") -> DataFrame:
    """Distinct names of entities appearing in any role (``UNION`` of one join
    per role).  The role ids are de-duplicated before the single join."""
    ids = _role_ids(matches, roles)
    return (ids.join(entities.select(F.col(key).alias("_id"), F.col(name).alias(out)), "_id")
               .select(out)
               .distinct())

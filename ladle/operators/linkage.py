"""Record linkage: records of one party in several systems become one entity (Fellegi-Sunter weights, learned without labels).

1. Equal records fold to one profile, so copies cost nothing further.
2. Blocking. A pass is a list of key parts, coarse to fine. A profile joins the block of the coarsest prefix that at most
   ``limit`` profiles share, so a hot block splits by its next part and no block compares more than ``limit`` profiles with each
   other. Members of a block that stays larger at its finest level are compared with its smallest member.
3. Candidates get one agreement level per field: differs, close, equal; missing values say nothing. Pairs are counted by pattern.
4. ``u``, how often unlike records agree, comes from value frequencies (equal) and from about as many random pairs as there are
   profiles (close). ``m`` and the share of matches come from expectation-maximisation over the pattern counts, at most
   ``4 ** fields`` rows.
5. Pairs of probability ``probability`` or more are links; entities are their connected components.

NULL and empty values are missing. A value of a field with ``common`` set that stands with more than that many different values of
the first field (a filler tax number) is missing too. A record whose present fields do not suffice to link it with its own copy
stays an entity of its own. Ids are unique and not NULL. An empty table gives an empty table.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from math import exp, log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ladle.session import shared_dir
from ladle.sinks import materialize

MISSING, DIFFERS, CLOSE, EQUAL = range(4)
SMALLEST = 1e-9
ROUNDS = 100


@dataclass(frozen=True)
class Field:
    """A compared column: ``close`` edits or fewer count as close; ``common`` as in the module text."""

    name: str
    close: int = 0
    common: int | None = None


@dataclass(frozen=True)
class Block:
    """A blocking pass: an expression giving an array of keys of a profile, and finer parts to split hot blocks by."""

    heads: str
    parts: tuple[str, ...] = ()


@dataclass(frozen=True)
class Weights:
    """Log of m / u by field and level, and the log odds that two records picked at random match."""

    prior: float
    levels: tuple[dict[int, float], ...]


def _staged(df: DataFrame, name: str) -> DataFrame:
    return materialize(df, shared_dir(df.sparkSession, f"linkage-{name}"))


def words(column: str, ignored: list[str]) -> Column:
    """A name's words in alphabetical order, without case, punctuation and the ``ignored`` ones (legal forms)."""
    plain = F.split(F.trim(F.regexp_replace(F.lower(F.col(column)), r"[^\p{L}\p{N}]+", " ")), " ")
    return F.array_sort(F.array_except(plain, F.array(*[F.lit(w) for w in ["", *ignored]])))


def _profiles(records: DataFrame, id_col: str, fields: list[Field]) -> tuple[DataFrame, DataFrame]:
    """(profile, fields) and (id, profile): equal records are one profile, named by the smallest id."""
    values = [F.when(F.trim(F.col(f.name).cast("string")) != "", F.col(f.name).cast("string")).alias(f.name) for f in fields]
    clean = records.select(F.col(id_col).alias("id"), *values)
    first = fields[0].name
    for field in fields:
        if field.common is None:
            continue
        filler = (clean.select(field.name, first).filter(F.col(field.name).isNotNull()).distinct().groupBy(field.name).count()
                  .filter(F.col("count") > field.common).select(F.col(field.name).alias("_filler")))
        clean = clean.join(filler, F.col(field.name) == F.col("_filler"), "left").withColumn(
            field.name, F.when(F.col("_filler").isNull(), F.col(field.name))).drop("_filler")
    names = [f.name for f in fields]
    named = _staged(clean.withColumn("digest", F.sha2(F.to_json(F.struct(*names), {"ignoreNullFields": "false"}), 256)), "records")
    folded = named.groupBy("digest").agg(F.min("id").alias("profile"), *[F.first(n).alias(n) for n in names])
    profiles = _staged(folded, "profiles")
    members = named.select("id", "digest").join(profiles.select("digest", "profile"), "digest").select("id", "profile")
    return profiles.drop("digest"), members


def level(field: Field, a: Column, b: Column) -> Column:
    """Agreement level of two values of a field."""
    out = F.when(a.isNull() | b.isNull(), MISSING).when(a == b, EQUAL)
    if field.close:
        out = out.when(F.levenshtein(a, b, field.close) >= 0, CLOSE)
    return out.otherwise(DIFFERS)


def _compared(pairs: DataFrame, fields: list[Field]) -> DataFrame:
    """(a, b, levels) of pairs of structs ``left`` and ``right``."""
    levels = [level(f, F.col(f"left.{f.name}"), F.col(f"right.{f.name}")) for f in fields]
    return pairs.select(F.col("left.profile").alias("a"), F.col("right.profile").alias("b"), F.array(*levels).alias("levels"))


def candidates(profiles: DataFrame, fields: list[Field], blocks: list[Block], limit: int = 40) -> DataFrame:
    """(a, b, levels) of every pair that shares a block, a < b, each once."""
    row = F.struct("profile", *[f.name for f in fields])
    parts = []
    for number, block in enumerate(blocks):
        heads = profiles.select(row.alias("row"), F.explode(F.array_distinct(F.expr(block.heads))).alias("head"), *[
            F.expr(p).alias(f"part{i}") for i, p in enumerate(block.parts)])
        keys = [F.struct(F.lit(depth).alias("depth"), F.lit(depth == len(block.parts)).alias("finest"), F.xxhash64(
            F.lit(number), F.lit(depth), "head", *[F.col(f"part{i}") for i in range(depth)]).alias("key")) for depth in range(len(block.parts) + 1)]
        parts.append(heads.filter("head IS NOT NULL").select("row", F.lit(number).alias("pass"), "head", F.inline(F.array(*keys))))
    entries = _staged(reduce(DataFrame.unionByName, parts), "entries")
    sizes = entries.groupBy("key").agg(F.count("*").alias("size")).filter(F.col("size") > limit)
    # Only hot blocks are looked up; a profile leaves them for its coarsest block that is not hot.
    sized = entries.join(sizes, "key", "left").withColumn("hot", F.col("size").isNotNull())
    chosen = sized.filter(~F.col("hot") | F.col("finest")).groupBy("row.profile", "pass", "head").agg(
        F.min_by(F.struct("row", "key", "hot"), "depth").alias("best")).select("best.*")
    chosen = _staged(chosen, "blocks")
    small = chosen.filter("NOT hot").select("key", "row")
    within = small.withColumnRenamed("row", "left").join(small.withColumnRenamed("row", "right"), "key").filter("left.profile < right.profile")
    large = chosen.filter("hot").select("key", "row")
    centre = large.groupBy("key").agg(F.min_by("row", "row.profile").alias("left"))
    star = large.withColumnRenamed("row", "right").join(centre, "key").filter("left.profile < right.profile")
    pairs = within.select("left", "right").unionByName(star.select("left", "right"))
    return _compared(pairs, fields).distinct()


def _chance(profiles: DataFrame, fields: list[Field], total: int) -> list[dict[int, float]]:
    """u: the share of the pairs of profiles, matches or not, that agree at a level, among pairs where both values are present."""
    row = F.struct("profile", *[f.name for f in fields])
    dealt = profiles.select(row.alias("row"), F.pmod(F.xxhash64("profile"), F.lit(max(total // 2, 1))).alias("deal"))
    pairs = dealt.withColumnRenamed("row", "left").join(dealt.withColumnRenamed("row", "right"), "deal").filter("left.profile < right.profile")
    counts = _compared(pairs, fields).agg(*[
        F.count_if((F.col("levels")[i] == lv)).alias(f"c{i}_{lv}") for i in range(len(fields)) for lv in (DIFFERS, CLOSE, EQUAL)]).first()
    out = []
    for i, field in enumerate(fields):
        seen = profiles.filter(F.col(field.name).isNotNull()).groupBy(field.name).count().agg(
            F.sum("count").alias("n"), F.sum(F.expr("count * (count - 1D)")).alias("same")).first()
        present = seen["n"] or 0
        equal = max((seen["same"] or 0.0) / max(present * (present - 1.0), 1.0), SMALLEST)
        drawn = sum(counts[f"c{i}_{lv}"] for lv in (DIFFERS, CLOSE, EQUAL))
        close = (counts[f"c{i}_{CLOSE}"] + 1) / (drawn + 2) if field.close else 0.0
        equal = min(equal, 1 - SMALLEST)
        close = min(close, (1 - equal) / 2)
        out.append({EQUAL: equal, CLOSE: close, DIFFERS: max(1 - equal - close, SMALLEST)})
    return out


def fit(patterns: list[tuple[tuple[int, ...], int]], chance: list[dict[int, float]], pairs: float) -> Weights:
    """m and the share of matches among all ``pairs`` by expectation-maximisation; pairs outside ``patterns`` are no matches."""
    m = [{EQUAL: 0.9, CLOSE: 0.07, DIFFERS: 0.03} if u[CLOSE] else {EQUAL: 0.95, CLOSE: 0.0, DIFFERS: 0.05} for u in chance]
    share = min(0.5, sum(n for _, n in patterns) / 2 / max(pairs, 1.0)) or SMALLEST

    def weights() -> Weights:
        return Weights(log(share / (1 - share)), tuple(
            {lv: log(mf[lv] / u[lv]) for lv in u if u[lv]} for mf, u in zip(m, chance)))

    for _ in range(ROUNDS):
        now = weights()
        posterior = [(levels, n / (1 + exp(-max(min(total(now, levels), 500.0), -500.0)))) for levels, n in patterns]
        matched = sum(p for _, p in posterior)
        before, share = share, min(max(matched / max(pairs, 1.0), SMALLEST ** 2), 0.5)
        for i, u in enumerate(chance):
            held = {lv: sum(p for levels, p in posterior if levels[i] == lv) for lv in u if u[lv]}
            # One imagined match, spread like the start, keeps every level possible.
            whole = sum(held.values()) + 1
            m[i] = {lv: max((held.get(lv, 0.0) + {EQUAL: 0.9, CLOSE: 0.07, DIFFERS: 0.03}[lv]) / whole, SMALLEST) for lv in u}
        if abs(share - before) <= 1e-12 * share:
            break
    return weights()


def total(weights: Weights, levels: tuple[int, ...]) -> float:
    """Log odds that a pair of these agreement levels matches."""
    return weights.prior + sum(w.get(lv, 0.0) for w, lv in zip(weights.levels, levels))


def log_odds(weights: Weights, levels: Column) -> Column:
    """``total`` as a column over an array of levels."""
    out = F.lit(weights.prior)
    for i, by_level in enumerate(weights.levels):
        part = F.lit(0.0)
        for lv, weight in by_level.items():
            part = F.when(levels[i] == lv, F.lit(weight)).otherwise(part)
        out = out + part
    return out


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable over undirected ``edges`` (a, b); nodes without an edge do not appear.

    Large-star and small-star in turn: every node hands its larger, then its smaller neighbours to the smallest one. Both are a
    map-side minimum and a join, so a node with very many neighbours is no task of its own.
    """
    edges = _staged(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), "edges")
    before = None
    while True:
        both = edges.union(edges.select("b", "a")).toDF("u", "v")
        smallest = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = _staged(both.filter("v > u").join(smallest, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct(), "large-star")
        lower = large.groupBy("a").agg(F.min("b").alias("m"))
        handed = large.join(lower, "a")
        edges = _staged(handed.select(F.col("b").alias("a"), F.col("m").alias("b")).union(lower.select("a", F.col("m").alias("b")))
                        .filter("a <> b").distinct(), "small-star")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        before = state


def learn(profiles: DataFrame, pairs: DataFrame, fields: list[Field]) -> Weights:
    """Weights from all profiles and all candidate pairs. Only counts by pattern reach the driver."""
    n = profiles.count()
    counted = sorted((tuple(r["levels"]), r["count"]) for r in pairs.groupBy("levels").count().collect())
    return fit(counted, _chance(profiles, fields, n), n * (n - 1) / 2)


def resolve(records: DataFrame, id_col: str, fields: list[Field], blocks: list[Block], limit: int = 40,
            probability: float = 0.9) -> DataFrame:
    """(id_col, entity_id, members): the entity of every record, named by its smallest id, and how many records it has."""
    profiles, members = _profiles(records, id_col, fields)
    pairs = _staged(candidates(profiles, fields, blocks, limit), "pairs")
    weights = learn(profiles, pairs, fields)
    bound = log(probability / (1 - probability))
    links = pairs.filter(log_odds(weights, F.col("levels")) >= bound).select("a", "b")
    roots = components(links)
    own = F.array(*[level(f, F.col(f.name), F.col(f.name)) for f in fields])
    known = profiles.select("profile", (log_odds(weights, own) >= bound).alias("firm")).join(
        roots.withColumnRenamed("node", "profile"), "profile", "left")
    named = members.join(known, "profile").select(
        F.col("id").alias(id_col), F.when(F.col("firm") | F.col("root").isNotNull(), F.coalesce("root", "profile")).otherwise(F.col("id")).alias("entity_id"))
    named = _staged(named, "entities")
    return named.join(named.groupBy("entity_id").agg(F.count("*").alias("members")), "entity_id").select(id_col, "entity_id", "members")

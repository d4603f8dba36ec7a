"""Mixing sources to target weights.

Sizes are words. The sources, in order of code points (null last), get weights, and together they
are to give `SHARE` times all words; no source gives more than `LIMIT` times its own, what is above
is shared again by weight. A source that must give more than it has repeats whole passes over its
documents, and of its last pass takes documents in a permuted order until the target is met; the
document at the edge gives the part that is missing.

Each document copy is a block. The exact number of blocks of every source is split among the output
shards by a tree: the shards are halved again and again, and at each node the halves draw their
blocks from the sources by a multivariate hypergeometric draw. So all shards have equal numbers of
blocks (give or take one), random shares of the sources, and quotas that sum to the sources' own.
A shard's blocks of a source are the next ones of the source's permuted order: disjoint, and
random. Inside a shard, blocks are ordered by another hash.

The permuted order is that of a seeded hash of id and text. What a row needs to know is then a few
hash values per source (where the last pass ends, where shards begin), found by counting hash
buckets of about `BUCKET` rows and looking into the few that hold a wanted rank. Texts are not
shuffled for the plan, and no task sees a whole source. Sources are known to the driver: at most
`MAX_SOURCES`, else an error says so. Results depend on the rows alone, so reruns agree.

Defined results: a null text has size 0 and is taken as an empty document. Without any words all
targets are 0. Equal rows (same id, same text) are treated alike, so a target may be missed by such
rows' sizes. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import space_words

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
LIMIT = 2
BUCKET = 256
MAX_SOURCES = 100_000
SHARDS = 64
#: Words of a shard that one task takes; a larger shard is written by several.
SLICE_WORDS = 20_000_000

_HALF = 1 << 31


def source_key(source: Column) -> Column:
    """Sources as text, null told apart from every text."""
    return F.when(source.isNull(), F.lit("null")).otherwise(F.concat(F.lit("="), source.cast("string")))


def in_order(keys: list[str]) -> list[str]:
    return sorted(keys, key=lambda k: (k == "null", k))


def targets(sizes: list[int], weights=WEIGHTS, share: float = SHARE, limit: float = LIMIT) -> list[float]:
    """Words each source is to give, in the sources' order."""
    out = [0.0] * len(sizes)
    left, open_ = share * sum(sizes), list(range(len(sizes)))
    weight = [weights[i % len(weights)] for i in range(len(sizes))]
    while open_:
        total = sum(weight[i] for i in open_)
        shares = {i: left * weight[i] / total for i in open_}
        full = [i for i in open_ if shares[i] > limit * sizes[i]]
        if not full:
            for i in open_:
                out[i] = shares[i]
            break
        for i in full:
            out[i] = float(limit * sizes[i])
        left -= sum(out[i] for i in full)
        open_ = [i for i in open_ if i not in set(full)]
    return out


def hypergeometric(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """How many of n blocks drawn without replacement are good; exact for all sizes.

    Every block is taken with the same chance, which leaves a random set of nearly n. To make it n,
    what is too much is drawn from the set, or what lacks from the others, in the same way: a number
    of about the square root of the one before. The last few are drawn one by one.
    """
    taken, sign = 0, 1
    while n > 32:
        if good + bad == n:
            return taken + sign * good
        chance = n / (good + bad)
        own, other = int(rng.binomial(good, chance)), int(rng.binomial(bad, chance))
        taken += sign * own
        if own + other >= n:
            good, bad, n, sign = own, other, own + other - n, -sign
        else:
            good, bad, n = good - own, bad - other, n - own - other
    for _ in range(n):
        hit = int(rng.integers(good + bad)) < good
        taken += sign * hit
        good, bad = good - hit, bad - (not hit)
    return taken


def _draw(rng: np.random.Generator, counts: np.ndarray, n: int) -> np.ndarray:
    """n of the blocks at random, without replacement, as counts per source."""
    total = int(counts.sum())
    if total < 10**9:
        return rng.multivariate_hypergeometric(counts, n, method="marginals")
    # the generator's bound: the same distribution source by source, each against all later ones
    drawn = np.zeros_like(counts)
    for i, own in enumerate(counts.tolist()):
        total -= own
        drawn[i] = hypergeometric(rng, own, total, n)
        n -= int(drawn[i])
    return drawn


def split(counts: list[int], shards: int, seed: int) -> np.ndarray:
    """Blocks of each source (column) for each shard (row)."""
    out = np.zeros((shards, len(counts)), dtype=np.int64)
    rng = np.random.default_rng(seed)

    def part(first: int, last: int, held: np.ndarray) -> None:
        if last - first == 1:
            out[first] = held
            return
        middle = (first + last) // 2
        n = int(held.sum()) * (middle - first) // (last - first)
        left = _draw(rng, held, n)
        part(first, middle, left)
        part(middle, last, held - left)

    part(0, shards, np.array(counts, dtype=np.int64))
    return out


def _keyed(docs: DataFrame, seed: int, doc_id: str, text: str, source: str) -> DataFrame:
    """`docs` with _src, _size and _draw, the place in the permuted order."""
    draw = F.xxhash64(F.lit(seed), F.col(doc_id), F.col(text)).bitwiseAND(F.lit((1 << 62) - 1))
    return docs.withColumns(
        {
            "_src": source_key(F.col(source)),
            "_size": F.size(space_words(F.col(text))).cast("long"),
            "_draw": draw,
        }
    )


def _table(spark, rows: list[tuple], schema: str) -> DataFrame:
    return F.broadcast(spark.createDataFrame(rows, schema))


def plan(
    docs: DataFrame, shards: int = SHARDS, seed: int = 20, doc_id: str = "doc_id", text: str = "text", source: str = "source"
) -> list[dict]:
    """What rows need to know of each source: see `blocks`."""
    spark = docs.sparkSession
    rows = cut_lineage(_keyed(docs.select(doc_id, text, source), seed, doc_id, text, source).select("_src", "_size", "_draw"))
    held = {
        r["_src"]: (r["n"], r["words"])
        for r in rows.groupBy("_src").agg(F.count("*").alias("n"), F.sum("_size").alias("words")).limit(MAX_SOURCES + 1).collect()
    }
    if len(held) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    if not held:
        return []
    names = in_order(list(held))
    found = [
        {"src": k, "n": held[k][0], "words": held[k][1], "target": t}
        for k, t in zip(names, targets([held[k][1] for k in names]))
    ]
    for s in found:
        quota = round(s["target"])
        s["passes"] = quota // s["words"] if s["words"] else 0
        s["rest"] = quota - s["passes"] * s["words"]
        s["buckets"] = -(-s["n"] // BUCKET)

    # buckets along the permuted order, with what stands before them
    per_source = _table(spark, [(s["src"], s["buckets"]) for s in found], "_src string, _buckets long")
    place = F.shiftright("_draw", 31) * F.col("_buckets")
    bucketed = rows.join(per_source, "_src").withColumn("_bucket", F.shiftright(place, 31)).drop("_buckets")
    before = Window.partitionBy("_src").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    counted = cut_lineage(
        bucketed.groupBy("_src", "_bucket")
        .agg(F.count("*").alias("n"), F.sum("_size").alias("words"))
        .withColumns(
            {
                "n_before": F.coalesce(F.sum("n").over(before), F.lit(0)),
                "words_before": F.coalesce(F.sum("words").over(before), F.lit(0)),
            }
        )
    )
    inside = Window.partitionBy("_src", "_bucket").orderBy("_draw", "_size")

    # the row at which the last pass ends
    ends = _table(spark, [(s["src"], s["rest"]) for s in found if s["rest"]], "_src string, _rest long")
    hit = counted.join(ends, "_src").filter("words_before < _rest AND _rest <= words_before + words")
    edge = (
        bucketed.join(F.broadcast(hit.select("_src", "_bucket", "_rest", "n_before", "words_before")), ["_src", "_bucket"])
        .withColumns(
            {
                "_rank": F.col("n_before") + F.row_number().over(inside) - 1,
                "_upto": F.col("words_before") + F.sum("_size").over(inside.rowsBetween(Window.unboundedPreceding, 0)),
            }
        )
        .filter("_upto - _size < _rest AND _rest <= _upto")
        .select("_src", "_rank", "_draw", (F.col("_rest") - F.col("_upto") + F.col("_size")).alias("part"))
    )
    at = {r["_src"]: r for r in edge.collect()}
    for s in found:
        e = at.get(s["src"])
        s |= {"edge": e["_draw"] if e else -1, "part": e["part"] if e else 0, "extra": e["_rank"] + 1 if e else 0}
        s["blocks"] = s["passes"] * s["n"] + s["extra"]

    # the blocks at which shards begin, as ranks and then as places in the order
    begins = np.cumsum(split([s["blocks"] for s in found], shards, seed), axis=0)[:-1]
    wanted = {
        (s["src"], int(b) % s["n"]) for i, s in enumerate(found) for b in begins[:, i] if b < s["blocks"]
    }
    place_of = {}
    if wanted:
        ranks = _table(spark, sorted(wanted), "_src string, _rank long")
        holds = counted.join(ranks, "_src").filter("n_before <= _rank AND _rank < n_before + n")
        holds = holds.groupBy("_src", "_bucket", "n_before").agg(F.collect_set("_rank").alias("_ranks"))
        near = (
            bucketed.join(F.broadcast(holds), ["_src", "_bucket"])
            .withColumn("_rank", F.col("n_before") + F.row_number().over(inside) - 1)
            .filter(F.array_contains("_ranks", F.col("_rank")))
            .select("_src", "_rank", "_draw")
        )
        place_of = {(r["_src"], r["_rank"]): r["_draw"] for r in near.collect()}
    for i, s in enumerate(found):
        s["begins"] = [
            (int(b) // s["n"], place_of[s["src"], int(b) % s["n"]]) if b < s["blocks"] else (LIMIT + 1, 0)
            for b in begins[:, i]
        ]
    return found


def blocks(
    docs: DataFrame, shards: int = SHARDS, seed: int = 20, doc_id: str = "doc_id", text: str = "text",
    source: str = "source", found: list[dict] | None = None,
) -> DataFrame:
    """`docs` with size, source_size, target and the list `blocks` of (copy, shard, words, place).

    A document's first copies are whole; the last may be the part at the edge. `place` orders the
    blocks of a shard. `found` is the result of `plan` when it is known already.
    """
    found = plan(docs, shards, seed, doc_id, text, source) if found is None else found
    schema = (
        "_src string, _words long, _target double, _passes long, _edge long, _part long, "
        "_begins array<struct<copy:long,place:long>>"
    )
    rows = [(s["src"], s["words"], float(s["target"]), s["passes"], s["edge"], s["part"], s["begins"]) for s in found]
    df = _keyed(docs, seed, doc_id, text, source).join(_table(docs.sparkSession, rows, schema), "_src")
    made = [
        F.struct(
            F.lit(copy).alias("copy"),
            F.size(
                F.filter(
                    "_begins",
                    lambda b: (b["copy"] < copy) | ((b["copy"] == copy) & (b["place"] <= F.col("_draw"))),  # noqa: B023
                )
            ).alias("shard"),
            F.when(F.col("_passes") > copy, F.col("_size"))
            .when(F.col("_passes") < copy, F.lit(None))
            .when(F.col("_draw") < F.col("_edge"), F.col("_size"))
            .when(F.col("_draw") == F.col("_edge"), F.col("_part"))
            .cast("long")
            .alias("words"),
            F.xxhash64(F.lit(seed), F.col("_draw"), F.lit(copy)).alias("place"),
        )
        for copy in range(LIMIT)
    ]
    return df.withColumns(
        {
            "size": F.col("_size"),
            "source_size": F.col("_words"),
            "target": F.col("_target"),
            "blocks": F.filter(F.array(*made), lambda b: b["words"].isNotNull()),
        }
    ).drop("_src", "_words", "_target", "_passes", "_edge", "_part", "_begins", "_size", "_draw")


def mixed(docs: DataFrame, shards: int = SHARDS, seed: int = 20) -> DataFrame:
    """The mix as whole documents: columns of `docs` and `shard`, shuffled within each shard.

    The document at a source's edge is in when at least half of it is due. An own column `shard` is
    replaced, all others stay as they are.
    """
    own = {c: f"_own_{c}" for c in ("size", "source_size", "target", "blocks") if c in docs.columns}
    docs = docs.drop("shard").withColumnsRenamed(own)
    found = plan(docs, shards, seed)
    slices = max(1, -(-round(sum(s["target"] for s in found)) // (shards * SLICE_WORDS)))
    due = blocks(docs, shards, seed, found=found).select(*docs.columns, "size", F.explode("blocks").alias("_block"))
    whole = due.filter(2 * F.col("_block.words") >= F.col("size"))
    return (
        whole.select(*docs.columns, F.col("_block.shard").alias("shard"), F.col("_block.place").alias("_place"))
        .withColumn("_slice", F.pmod("_place", F.lit(slices)))
        .repartition(shards * slices, "shard", "_slice")
        .sortWithinPartitions("shard", "_place")
        .drop("_place", "_slice")
        .withColumnsRenamed({hidden: c for c, hidden in own.items()})
    )


def digest(docs: DataFrame) -> DataFrame:
    """The contract's columns."""
    taken = F.aggregate("blocks", F.lit(0).cast("long"), lambda total, b: total + b["words"])
    return blocks(docs.select("doc_id", "text", "source")).select(
        "doc_id", "size", "source_size", "target", taken.alias("taken"), F.transform("blocks", lambda b: b["shard"]).alias("shards")
    )

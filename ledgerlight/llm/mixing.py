"""Mixing sources to target weights (operator 3): temperature mixing with budgeted block permutations.

Source token shares p are raised to an exponent a and normalised; a is bisected until the mixture meets a target entropy,
or until no source repeats more often than a limit. The weights are then realised on rows: every source's documents are
dealt by hash into blocks of about ``block_tokens`` tokens, each epoch is a permutation of the blocks, and a source takes
whole epochs and then blocks in that order until its token budget is spent; inside the one block where the budget ends,
documents are taken in hash order. Texts are counted once; what is written of that, a hash and a number for each row, makes
the plan, and a second pass over the rows places them. A source has at most MOST_BLOCKS blocks, larger ones if it has more
tokens, so its permutations are worked in one task at any size of the table and the hot source is as even as its blocks.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import tokens
from .common import arrow_map, column_or_null, in_chunks, local_table, materialize, table, texts


#: Most blocks of a source; a block has more than the tokens asked for where a source would have more blocks.
MOST_BLOCKS = 1 << 16


def tempered(shares: list[float], exponent: float) -> list[float]:
    """Shares to the power of the exponent, normalised; shares of 0 stay 0."""
    top = max(shares, default=0.0)
    raised = [(p / top) ** exponent if p > 0 else 0.0 for p in shares]
    total = sum(raised)
    return [x / total for x in raised] if total else raised


def entropy(weights: list[float]) -> float:
    return -sum(w * math.log(w) for w in weights if w > 0)


def bisect(fits: Callable[[float], bool], steps: int = 60) -> float:
    """Least exponent in [0, 1] from which on fits holds; 1 if it never does. fits is false below and true above."""
    low, high = 0.0, 1.0
    if fits(low):
        return low
    for _ in range(steps):
        middle = (low + high) / 2
        low, high = (low, middle) if fits(middle) else (middle, high)
    return high


def epochs(totals: list[int], exponent: float, budget: int | None) -> list[float]:
    """How often each source is read. Without a budget, the least one under which every source is read whole once."""
    whole = sum(totals)
    weights = tempered([t / whole for t in totals], exponent) if whole else []
    tokens = budget if budget is not None else max((t / w for t, w in zip(totals, weights) if w > 0), default=0)
    return [w * tokens / t if t else 1.0 for w, t in zip(weights, totals)]


def choose_exponent(totals: list[int], max_epochs: float | None, target_entropy: float | None, budget: int | None) -> float:
    """Flattest mixture whose repetitions stay within max_epochs, and whose entropy is at most the target if one is given."""
    whole = sum(totals)
    if not whole:
        return 1.0
    shares = [t / whole for t in totals]
    if target_entropy is not None:
        flat = bisect(lambda a: entropy(tempered(shares, a)) <= target_entropy)
    else:
        flat = 0.0
    if max_epochs is None:
        return flat
    return max(flat, bisect(lambda a: max(epochs(totals, a, budget)) <= max_epochs))


def n_words(text: Column) -> Column:
    """Words between white space; the token measure where no tokenizer is given. Empty and null text: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def counted(rows: DataFrame, tokenizer: str | None) -> DataFrame:
    """source, draw, n of rows(source, text, draw): tokens of a tokenizer file, or words without one. Null text has none."""
    if tokenizer is None:
        return rows.select("source", "draw", n_words(F.col("text")).alias("n"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = tokens.encoder(tokenizer)
        for batch in in_chunks(batches, "text", 4 << 20):
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array([len(enc.ids(t)) for t in texts(batch)], pa.int64())], ["source", "draw", "n"])

    return arrow_map(rows.select("source", "text", "draw"), run, "source string, draw long, n long")


def mix(docs: DataFrame, max_epochs: float | None = 2.0, target_entropy: float | None = None, budget: int | None = None, block_tokens: int = 1 << 20, seed: int = 17, tokenizer: str | None = None) -> DataFrame:
    """docs' rows as often as the mixture takes them, plus mix_epoch, mix_block, mix_rank and mix_weight.

    mix_epoch counts from 0; mix_rank, from 1, is the block's place in the epoch's permutation of its source's blocks;
    mix_weight is the source's share. budget None takes the least number of tokens under which every source is read whole at
    least once, so that no row is lost and smaller sources repeat. With a budget, sources may also be read in part. Tokens are
    those of the tokenizer file, or words where none is given. Rows without tokens cost nothing and come in every epoch that
    their block is in; null source is a source; equal rows are dealt alike; texts of any length are counted whole; extra
    columns are kept (except mix_*, which are replaced); an empty table gives no rows. Driver memory: one total per source.
    """
    keep = [c for c in docs.columns if c.lower() not in {"mix_epoch", "mix_block", "mix_rank", "mix_weight"}]
    source = column_or_null(docs, "source", "string").cast("string").alias("source")
    draw = F.xxhash64(F.col("doc_id"), F.col("text"), F.lit(seed)).alias("draw")
    held = materialize(counted(docs.select(source, F.col("text").cast("string").alias("text"), draw), tokenizer), "mix-counts")
    totals = sorted(((r[0], r[1]) for r in held.groupBy("source").agg(F.sum("n")).collect()), key=lambda x: (x[0] is not None, x[0] or ""))
    exponent = choose_exponent([t for _, t in totals], max_epochs, target_entropy, budget)
    turns = epochs([t for _, t in totals], exponent, budget) or [1.0] * len(totals)
    whole = sum(t for _, t in totals)
    weights = tempered([t / whole for _, t in totals], exponent) if whole else [0.0] * len(totals)

    full = [math.floor(e + 1e-9) for e in turns]
    plan = local_table(
        docs.sparkSession,
        {
            "p_source": pa.array([s for s, _ in totals], pa.string()),
            "p_blocks": pa.array([min(MOST_BLOCKS, max(1, -(-t // block_tokens))) for _, t in totals], pa.int64()),
            "p_whole": pa.array(full, pa.int32()),
            "p_rest": pa.array([round(max(0.0, e - k) * t) for (_, t), e, k in zip(totals, turns, full)], pa.int64()),
            "p_weight": pa.array(weights, pa.float64()),
        },
    )
    block = F.pmod("draw", F.col("p_blocks"))
    dealt = held.join(plan, F.col("source").eqNullSafe(F.col("p_source"))).select("p_source", "p_whole", "p_rest", block.alias("block"), F.xxhash64("draw").alias("place"), "n")
    order = lambda epoch: [F.xxhash64("block", epoch, F.lit(seed)), F.col("block")]
    before = Window.partitionBy("p_source").orderBy(*order(F.col("p_whole"))).rowsBetween(Window.unboundedPreceding, -1)
    blocks = dealt.groupBy("p_source", "block", "p_whole", "p_rest").agg(F.sum("n").alias("n"))  # at most MOST_BLOCKS a source
    blocks = materialize(blocks.withColumn("room", F.col("p_rest") - F.coalesce(F.sum("n").over(before), F.lit(0))), "mix-blocks")

    # the last document that the budget covers in the one block of a source where it ends
    edge = (F.col("room") > 0) & (F.col("room") < F.col("n"))
    ends = blocks.where(edge).select(F.col("p_source").alias("e_source"), F.col("block").alias("e_block"), "room")
    inside = dealt.select("p_source", "block", "place", "n").join(ends, F.col("p_source").eqNullSafe(F.col("e_source")) & (F.col("block") == F.col("e_block")))
    so_far = Window.partitionBy("p_source", "block").orderBy("place").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    last = inside.withColumn("upto", F.sum("n").over(so_far)).where(F.col("upto") <= F.col("room")).groupBy("p_source").agg(F.max("place").alias("l_place"))
    last = materialize(last.withColumnRenamed("p_source", "l_source"), "mix-last")

    # every epoch's permutation: the whole ones, and of the last one the blocks that the budget reaches
    turn = F.explode(F.sequence(F.lit(0), F.col("p_whole"))).alias("epoch")
    ranks = blocks.select("p_source", "block", "p_whole", (F.col("room") > 0).alias("reached"), edge.alias("edge"), turn)
    rank = F.row_number().over(Window.partitionBy("p_source", "epoch").orderBy(*order(F.col("epoch"))))
    ranks = ranks.withColumn("rank", rank.cast("long")).where((F.col("epoch") < F.col("p_whole")) | F.col("reached"))
    taken = F.struct("epoch", "rank", (F.col("edge") & (F.col("epoch") == F.col("p_whole"))).alias("edge"))
    ranks = materialize(ranks.groupBy(F.col("p_source").alias("r_source"), F.col("block").alias("r_block")).agg(F.collect_list(taken).alias("turns")), "mix-ranks")

    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), source, draw).join(plan, F.col("source").eqNullSafe(F.col("p_source")))
    rows = rows.select("row", "source", "p_weight", block.alias("block"), F.xxhash64("draw").alias("place"))
    rows = rows.join(ranks, F.col("source").eqNullSafe(F.col("r_source")) & (F.col("block") == F.col("r_block"))).join(last, F.col("source").eqNullSafe(F.col("l_source")), "left")
    reached = F.coalesce(F.col("place") <= F.col("l_place"), F.lit(False))
    rows = rows.select("row", "block", "p_weight", F.explode(F.filter("turns", lambda t: ~t["edge"] | reached)).alias("turn"))
    out = {"mix_epoch": F.col("turn.epoch"), "mix_block": F.col("block"), "mix_rank": F.col("turn.rank"), "mix_weight": F.col("p_weight")}
    return rows.select(*[F.col("row").getField(c).alias(c) for c in keep], *[c.alias(n) for n, c in out.items()])


def op3_mixing(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return mix(docs.select("doc_id", "source", "text"), tokenizer=tokens.default_path()).select("doc_id", "source", "mix_epoch", "mix_block", "mix_rank", "mix_weight")


QUERIES = {"op3_mixing": op3_mixing}
ORACLE_SQL: dict[str, str] = {}

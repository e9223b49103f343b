"""Quality rules (operator 9), DataFrame functions only.

Counts come from array functions on each row, so whole texts are judged without a shuffle and a very long text costs a
sort of its own words. Thresholds come from mergeable KLL sketches per (lang, source): every task sketches what it reads
and sketches are merged. No threshold is a constant: a fence is the group's median times a power of its spread, median over
lowest decile. The lower half alone sets it, so up to half of a group can be junk without opening it. Counts are smoothed before
they are sketched, as a text without symbols shows a small share only as far as its length goes; so shares that are
nearly always zero have a spread as well. The groups' sketches are merged for the same fences of a language and of all
rows. A group takes the greater of its own fence and its language's, so that a group that is mostly copies of one text,
and has next to no spread, doesn't reject the rest; a small group has its language's alone, and a small language that of
all rows. Rows are then joined with their group's fences.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import column_or_null, materialize, table

#: Characters counted as symbols; least words of a document; most words of a hundred in repeated windows.
SYMBOLS = "[#*$%&|<>]"
LEAST_WORDS = 50
MOST_REPEATED = 50

#: Adaptive rules: measure -> (smoothed measure that is sketched, as SQL on the counts; power of the spread; least
#: spread, as a count is known to within about one: texts of one length without symbols differ by less than a symbol).
RULES = {
    "symbol_share": ("(q_symbols + 1) / (q_chars + 1)", 2.0, 2.0),
    "dup_line_share": ("(2 * q_dup_lines + 1) / (2 * q_lines + 2)", 2.0, 2.0),
    "repeat_share": ("(q_repeat_words + 1) / (q_words + 1)", 4.0, 2.0),
    "word_length": ("q_chars / q_words", 4.0, 1.03),
}

#: Rows that pass the base rules that a group must have for fences of its own.
LEAST_ROWS = 20

#: KLL sketch size parameter: exact up to about as many rows, rank error under 0.2 % beyond; a group's sketch is no larger
#: than its rows and at most some 50 KB a measure.
SKETCH_K = 2048

#: Bits of a sort key that hold a position; longer texts take the wider layout.
NARROW, WIDE = 20, 31


def _keys(hashes: Column, shift: int, bits: int, positions: Column | None = None) -> Column:
    """Sorted keys: 63 - bits bits of each window's hash from bit ``shift`` on, above its position."""
    mask = (1 << (63 - bits)) - 1
    key = lambda h, p: F.shiftleft(F.shiftrightunsigned(h, shift).bitwiseAND(mask), bits).bitwiseOR(p)
    if positions is None:
        return F.sort_array(F.transform(hashes, lambda h, i: key(h, i.cast("long"))))
    return F.sort_array(F.transform(positions, lambda p: key(F.get(hashes, p.cast("int")), p)))


def _repeated(keys: Column, bits: int) -> Column:
    """Positions of the sorted keys whose hash part equals that of a neighbour."""
    same = lambda a, b: F.shiftrightunsigned(a, bits) == F.shiftrightunsigned(b, bits)
    marked = F.transform(keys, lambda k, i: F.when(same(k, F.get(keys, i - 1)) | same(k, F.get(keys, i + 1)), k.bitwiseAND((1 << bits) - 1)))
    return F.filter(marked, lambda p: p.isNotNull())


def measured(docs: DataFrame) -> DataFrame:
    """docs with q_words, q_chars, q_symbols, q_dup_lines, q_lines, q_repeat_words, base_failed and the shares that the rules use.

    q_repeat_words: words in 3-word windows found twice or more. A window's hash has 64 bits, made from its words' hashes.
    Texts whose window hashes are all different are done; for the others, sorted keys of hash bits and position show the
    windows found again, first by the low bits, then, among those, by the high bits, so that both parts must agree.
    Null text has no words and no lines; texts without a word have counts of 0; there is no longest text.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    none = F.array().cast("array<bigint>")
    out = docs.withColumn("q__words", F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != ""))
    out = out.withColumn("q__hash", F.transform("q__words", lambda w: F.xxhash64(w)))
    out = out.withColumns(
        {
            "q_words": F.size("q__words").cast("long"),
            "q_chars": F.length(F.array_join("q__words", "")).cast("long"),
            "q_symbols": F.regexp_count(text, F.lit(SYMBOLS)).cast("long"),
            "q__lines": F.filter(F.split(text, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]")),
            "q__windows": F.when(F.size("q__hash") < 3, none).otherwise(
                F.transform(F.sequence(F.lit(0), F.size("q__hash") - 3), lambda i: F.xxhash64(F.get("q__hash", i), F.get("q__hash", i + 1), F.get("q__hash", i + 2)))
            ),
        }
    ).drop("q__words", "q__hash")
    out = out.withColumns(
        {
            "q_dup_lines": (F.size("q__lines") - F.size(F.array_distinct("q__lines"))).cast("long"),
            "q_lines": F.size("q__lines").cast("long"),
            "q__again": F.size("q__windows") > F.size(F.array_distinct("q__windows")),
            "q__narrow": F.size("q__windows") < (1 << NARROW),
        }
    ).drop("q__lines")
    by = lambda narrow, wide: F.when(~F.col("q__again"), none).when(F.col("q__narrow"), narrow).otherwise(wide)
    for step, shift in (("q__k1", lambda bits: 0), ("q__k2", lambda bits: bits + 1)):
        positions = None if step == "q__k1" else F.col("q__found")
        out = out.withColumn(step, by(_keys(F.col("q__windows"), shift(NARROW), NARROW, positions), _keys(F.col("q__windows"), shift(WIDE), WIDE, positions)))
        out = out.withColumn("q__found", by(_repeated(F.col(step), NARROW), _repeated(F.col(step), WIDE)))
    out = out.withColumn("q_repeat_words", F.size(F.array_distinct(F.flatten(F.transform("q__found", lambda p: F.array(p, p + 1, p + 2))))).cast("long"))
    n = F.greatest(F.col("q_words"), F.lit(1))
    out = out.withColumns(
        {
            "symbol_share": F.col("q_symbols") / F.greatest(F.col("q_chars"), F.lit(1)),
            "dup_line_share": F.col("q_dup_lines") / F.greatest(F.col("q_lines"), F.lit(1)),
            "repeat_share": F.col("q_repeat_words") / n,
            "word_length": F.col("q_chars") / n,
            "base_failed": (F.col("q_words") < LEAST_WORDS) | (100 * F.col("q_repeat_words") > MOST_REPEATED * F.col("q_words")),
            # filters on the counts stay above this projection: pushed below it, they would repeat every array pass inside
            "q__row": F.monotonically_increasing_id(),
        }
    )
    return out.drop("q__windows", "q__again", "q__narrow", "q__k1", "q__k2", "q__found")


def fences(rows: DataFrame) -> DataFrame:
    """One row per (t_lang, t_source) with a row that passes the base rules: t_<measure>, the greatest value that passes;
    null where no level has enough rows and a spread, and the measure judges nothing.

    rows: measured() rows with q_lang and q_source. Size: groups of lang and source times four doubles. Driver: nothing.
    """
    passed = rows.where((F.col("q__row") >= 0) & ~F.col("base_failed"))
    own = passed.groupBy("q_lang", "q_source").agg(F.count("*").alias("n"), *[F.kll_sketch_agg_double(F.expr(x), F.lit(SKETCH_K)).alias(m) for m, (x, _, _) in RULES.items()])
    own = materialize(own, "sketches")
    merged = [F.sum("n").alias("n"), *[F.kll_merge_agg_double(F.col(m), F.lit(SKETCH_K)).alias(m) for m in RULES]]

    def level(df: DataFrame, p: str) -> DataFrame:
        names = [F.col(c).alias(f"{p}_{c[2:]}") for c in ("q_lang", "q_source") if c in df.columns]
        return df.select(*names, *[F.when(F.col("n") >= LEAST_ROWS, _fence(F.col(m), power, least)).alias(f"{p}_{m}") for m, (_, power, least) in RULES.items()])

    everything = level(own.agg(*merged).where("n > 0"), "a")  # one row
    wide = level(own, "t").join(level(own.groupBy("q_lang").agg(*merged), "l"), F.col("t_lang").eqNullSafe(F.col("l_lang")), "left").crossJoin(F.broadcast(everything))
    return wide.select("t_lang", "t_source", *[F.coalesce(F.greatest(F.col(f"t_{m}"), F.col(f"l_{m}")), F.col(f"a_{m}")).alias(f"t_{m}") for m in RULES])


def _fence(sketch: Column, power: float, least: float) -> Column:
    """Median * (median / lowest decile) ** power; null without a spread."""
    low, middle = (F.kll_sketch_get_quantile_double(sketch, F.lit(q)) for q in (0.1, 0.5))
    return F.when(middle > low, middle * F.pow(F.greatest(middle / low, F.lit(least)), F.lit(power)))


def _grouped(docs: DataFrame) -> DataFrame:
    return docs.withColumns({"q_lang": column_or_null(docs, "lang", "string").cast("string"), "q_source": column_or_null(docs, "source", "string").cast("string")})


def judged(rows: DataFrame, limits: DataFrame) -> DataFrame:
    """rows with kept, joined with their group's fences; null lang or source is a group of its own.

    limits has a file's statistics: it is broadcast below Spark's threshold only, and joined by shuffle beyond it.
    """
    joined = rows.where("q__row >= 0").join(limits, F.col("q_lang").eqNullSafe(F.col("t_lang")) & F.col("q_source").eqNullSafe(F.col("t_source")), "left")
    passed = F.lit(True)
    for m in RULES:
        passed = passed & F.coalesce(F.col(m) <= F.col(f"t_{m}"), F.lit(True))
    return joined.withColumn("kept", ~F.col("base_failed") & passed)


def measure_and_judge(docs: DataFrame) -> DataFrame:
    """doc_id, the counts, base_failed and kept for every row of docs; texts are read once.

    Null lang or source is a value of its own. Null and empty texts have no words and fail the base rules; of values equal
    to a fence, all pass. Empty tables give no rows; repeated rows are judged row by row; extra columns are ignored.
    """
    rows = _grouped(docs.select("doc_id", "text", column_or_null(docs, "lang", "string"), column_or_null(docs, "source", "string")))
    held = materialize(measured(rows).drop("text", "lang", "source"), "quality")
    return judged(held, materialize(fences(held), "fences"))


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of docs that pass, with docs' columns. Rows are measured once and written with their measures, as the
    fences need all of them first; writing a text costs a fraction of measuring it again.

    Columns of docs whose names this operator uses (q_*, t_*, the measures) are kept unharmed.
    """
    inner = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("text"), column_or_null(docs, "lang", "string"), column_or_null(docs, "source", "string"))
    held = materialize(measured(_grouped(inner)).drop("text", "lang", "source"), "measured")
    kept = judged(held, materialize(fences(held), "fences")).where("kept")
    return kept.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def op9_quality(spark, sf_dir: str) -> DataFrame:
    out = measure_and_judge(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.col("q_words").alias("n_words"), F.col("q_chars").alias("word_chars"), F.col("q_symbols").alias("n_symbols"), F.col("q_dup_lines").alias("n_dup_lines"), F.col("q_repeat_words").alias("n_repeat_words"), "base_failed", "kept")


QUERIES = {"op9_quality": op9_quality}
_SKETCHED = {m: x.replace("q_symbols", "n_symbols").replace("q_chars", "word_chars").replace("q_dup_lines", "n_dup_lines").replace("q_lines", "n_lines").replace("q_repeat_words", "n_repeat_words").replace("q_words", "n_words") for m, (x, _, _) in RULES.items()}
_LEVEL = ", ".join(
    f"CASE WHEN count(*) >= {LEAST_ROWS} AND quantile_disc(z_{m}, 0.5) > quantile_disc(z_{m}, 0.1) THEN quantile_disc(z_{m}, 0.5) * pow(greatest(quantile_disc(z_{m}, 0.5) / quantile_disc(z_{m}, 0.1), {least}), {power}) END AS t_{m}" for m, (_, power, least) in RULES.items()
)
_PASSES = " AND ".join(f"coalesce({m} <= coalesce(greatest(f.t_{m}, l.t_{m}), a.t_{m}), true)" for m in RULES)

#: With exact quantiles, which the sketches give as well while a level has no more rows than SKETCH_K.
ORACLE_SQL = {
    "op9_quality": f"""
WITH w AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS text, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM documents),
g AS (SELECT doc_id, unnest(range(1, len(ws) - 1)) AS i, ws FROM w WHERE len(ws) >= 3),
again AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, ws[i], ws[i + 1], ws[i + 2]) AS n FROM g),
covered AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM again WHERE n > 1) GROUP BY doc_id),
m AS (
  SELECT w.doc_id, lang, source, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars, (length(text) - length(regexp_replace(text, '{SYMBOLS}', '', 'g')))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, len(lines) AS n_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words FROM w LEFT JOIN covered c USING (doc_id)),
r AS (
  SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words AS base_failed, n_symbols / greatest(word_chars, 1) AS symbol_share, n_dup_lines / greatest(n_lines, 1) AS dup_line_share,
         n_repeat_words / greatest(n_words, 1) AS repeat_share, word_chars / greatest(n_words, 1) AS word_length FROM m),
z AS (SELECT lang, source, {", ".join(f"{x} AS z_{m}" for m, x in _SKETCHED.items())} FROM r WHERE NOT base_failed),
f AS (SELECT lang, source, {_LEVEL} FROM z GROUP BY lang, source),
l AS (SELECT lang, {_LEVEL} FROM z GROUP BY lang),
a AS (SELECT {_LEVEL} FROM z)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND {_PASSES} AS kept
FROM r CROSS JOIN a LEFT JOIN l ON l.lang IS NOT DISTINCT FROM r.lang LEFT JOIN f ON f.lang IS NOT DISTINCT FROM r.lang AND f.source IS NOT DISTINCT FROM r.source"""
}

"""Quality rules with risk-controlled thresholds (DataFrame functions only).

Fixed base rules fail a document outright.  Beside them each rule of
:data:`RULES` has a score from 0 to 1, and a stratum has a vector of cutoffs,
one per rule, chosen from one ordered family of vectors: each step lowers one
rule's cutoff by one bin.  The order is made from documents that the test does
not use, those labelled bad and those without a label: first come the steps
whose tails hold the most bad documents for each unlabelled one.  The labelled
good documents then test the steps in that order, all rules at once: an exact
binomial test must show that at most ``risk`` of the stratum's good documents
would be rejected by any rule.  The first step that is not proven ends the
search (a fixed sequence needs no correction inside it), so neither risk nor
error is divided by the rules; the error level is divided by the number of
strata and the pooled one (Bonferroni).

A stratum with fewer labelled good documents than a proof without any rejection
takes, but at least one, uses the cutoffs of the pooled stratum: all strata
together, with an order and a test of their own.  There at most ``risk`` of the
good documents of all strata together would be rejected.  A stratum with enough
of them whose test fails, or with none, gets no cutoffs.

Results: a null text has no words and fails; a null stratum is a stratum of
its own; labels of unknown documents are ignored, a document labelled more
than once counts as good if any label says so; repeated rows are judged row by
row; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonescope.llm.common import stored

MIN_WORDS = 50
BINS = 50
RISK = 0.01
ERROR = 0.05
#: The characters counted as symbols.
SYMBOLS = "#*$%&|<>"
_BREAKS = "\\x20\\x09-\\x0D"

#: Score of each rule, from the columns of :func:`features`.
RULES = {
    "symbol_share": lambda: F.col("n_symbols") / F.greatest(F.col("word_chars"), F.lit(1)),
    "mark_share": lambda: F.col("n_marks") / F.greatest(F.col("word_chars"), F.lit(1)),
    "dup_line_share": lambda: F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
    "repeat_share": lambda: F.col("n_repeat_words") / F.greatest(F.col("n_words"), F.lit(1)),
}
COUNTS = ("n_words", "word_chars", "n_symbols", "n_marks", "n_lines", "n_dup_lines", "n_repeat_words")


def features(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Add the counts of :data:`COUNTS`.

    Repeated 3-word windows: each window's 64-bit hash is packed above its
    position in one long, the longs are sorted, and neighbours with one hash
    are compared word by word.  Positions take as many bits as the document
    needs, so no length is excluded.
    """
    bare = F.trim(F.coalesce(F.col(text_col).cast("string"), F.lit("")), F.lit(" \t\n\x0b\x0c\r"))
    df = df.withColumn("_t", bare)
    df = df.withColumn("_w", F.when(F.col("_t") == "", F.array().cast("array<string>")).otherwise(F.split("_t", f"[{_BREAKS}]+")))
    # Lines are compared as they stand in the text, with the white space at their ends.
    whole = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    df = df.withColumn("_lines", F.filter(F.split(whole, "\n"), lambda x: x.rlike(f"[^{_BREAKS}]")))
    df = df.withColumns({"_n": F.size("_w"), "_chars": F.array_join("_w", "")})
    df = df.withColumn("_bits", F.expr("case when _n < 2 then 1 else cast(ceil(log2(_n)) as int) + 1 end"))
    df = df.withColumn("_windows", F.expr("""
        case when _n < 3 then cast(array() as array<bigint>) else sort_array(transform(sequence(0, _n - 3),
            i -> shiftleft(xxhash64(get(_w, i), get(_w, i + 1), get(_w, i + 2)), _bits) | cast(i as bigint))) end"""))
    df = df.withColumn("_mask", F.expr("shiftleft(1L, _bits) - 1"))
    same = """(shiftright(x, _bits) = shiftright(get(_windows, k {side} 1), _bits)
        and get(_w, cast(x & _mask as int)) = get(_w, cast(get(_windows, k {side} 1) & _mask as int))
        and get(_w, cast(x & _mask as int) + 1) = get(_w, cast(get(_windows, k {side} 1) & _mask as int) + 1)
        and get(_w, cast(x & _mask as int) + 2) = get(_w, cast(get(_windows, k {side} 1) & _mask as int) + 2))"""
    df = df.withColumn("_repeats", F.expr(f"""
        sort_array(transform(filter(_windows, (x, k) -> coalesce({same.format(side="-")}, false) or coalesce({same.format(side="+")}, false)), x -> x & _mask))"""))
    symbols = F.when(F.col("_chars").rlike(r"[#*$%&|<>]"), F.length("_chars") - F.length(F.translate("_chars", SYMBOLS, ""))).otherwise(0)
    marks = F.when(F.col("_chars").contains("!"), F.length("_chars") - F.length(F.replace("_chars", F.lit("!"), F.lit("")))).otherwise(0)
    df = df.withColumns({
        "n_words": F.col("_n").cast("long"),
        "word_chars": F.length("_chars").cast("long"),
        "n_symbols": symbols.cast("long"),
        "n_marks": marks.cast("long"),
        "n_lines": F.size("_lines").cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "n_repeat_words": F.expr("""aggregate(_repeats, named_struct('last', -1L, 'n', 0L),
            (a, x) -> named_struct('last', x + 2, 'n', a.n + least(3L, x + 2 - a.last)), a -> a.n)"""),
    })
    return df.drop("_t", "_w", "_lines", "_n", "_chars", "_bits", "_mask", "_windows", "_repeats")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _log_gamma(x: str) -> str:
    """ln of the gamma function for x >= 1 as SQL: Stirling's series at x + 8, taken back by the recurrence (error below 1e-12)."""
    z = f"({x} + 8)"
    series = f"({z} - 0.5D) * ln({z}) - {z} + 0.918938533204672742D + 1 / (12 * {z}) - 1 / (360 * pow({z}, 3)) + 1 / (1260 * pow({z}, 5)) - 1 / (1680 * pow({z}, 7))"
    return f"({series} - ln({x}) - " + " - ".join(f"ln({x} + {i})" for i in range(1, 8)) + ")"


def binomial_tail(k: str, n: str, p: str) -> Column:
    """P(Bin(n, p) <= k) as an expression over column names or numbers: the largest term, then its falling ratios."""
    kd, nd = f"cast({k} as double)", f"cast({n} as double)"
    top = f"exp({_log_gamma(f'({nd} + 1)')} - {_log_gamma(f'({kd} + 1)')} - {_log_gamma(f'({nd} - {kd} + 1)')} + {kd} * ln({p}) + ({nd} - {kd}) * ln(1 - {p}))"
    ratios = f"""aggregate(sequence(0L, cast({k} as bigint)), named_struct('term', 1D, 'sum', 0D),
        (a, i) -> named_struct('term', a.term * ({kd} - i) * (1 - {p}) / (({nd} - {kd} + i + 1) * {p}), 'sum', a.sum + a.term), a -> a.sum)"""
    return F.expr(f"least(1D, {top} * {ratios})")


def fit_cutoffs(measured: DataFrame, labels: DataFrame, stratum: str = "lang", risk: float = RISK, error: float = ERROR, id_col: str = "doc_id") -> DataFrame:
    """One row per stratum with a proven vector of cutoff bins; ``cut_<rule>`` is null where the vector does not cut by a rule."""
    known = labels.where(F.col(id_col).isNotNull() & F.col("quality").isNotNull()).groupBy(F.col(id_col).alias("_id")).agg(F.max("quality").alias("_good"))
    rows = measured.join(known, measured[id_col] == known["_id"], "left").where(~base_failed())
    names = list(RULES)
    cells = rows.groupBy(F.coalesce(F.col(stratum).cast("string"), F.lit("")).alias("stratum"), F.col("_good").alias("good"), *[_bin(score()).alias(name) for name, score in RULES.items()]).agg(F.count("*").alias("n"))
    cells = stored(cells, "quality-cells")
    cells = cells.withColumn("pooled", F.lit(False)).unionByName(cells.withColumns({"stratum": F.lit(""), "pooled": F.lit(True)}))
    key = ["pooled", "stratum"]
    good, others = cells.where("good = 1"), cells.where("good is null or good <> 1")
    totals = good.groupBy(*key).agg(F.sum("n").alias("total"))
    # Every cutoff of every rule with the unlabelled and bad documents it rejects, ordered into steps.
    tails = others.select(*key, F.when(F.col("good").isNull(), F.col("n")).otherwise(0).alias("new"), F.when(F.col("good").isNotNull(), F.col("n")).otherwise(0).alias("bad"),
                          F.posexplode(F.array(*names)).alias("rule", "cut")).groupBy(*key, "rule", "cut").agg(F.sum("new").alias("new"), F.sum("bad").alias("bad"))
    grid = totals.select(*key, F.explode(F.expr(f"sequence(0, {len(names) - 1})")).alias("rule")).withColumn("cut", F.explode(F.expr(f"sequence(1, {BINS})")))
    loosest_first = Window.partitionBy(*key, "rule").orderBy(F.col("cut").desc())
    steps = grid.join(tails, [*key, "rule", "cut"], "left").fillna(0, ["new", "bad"])
    steps = steps.withColumn("cost", F.sum("new").over(loosest_first) / (F.sum("bad").over(loosest_first) + 1)).withColumn("cost", F.max("cost").over(loosest_first))
    steps = steps.withColumn("step", F.row_number().over(Window.partitionBy(*key).orderBy("cost", F.col("cut").desc(), "rule"))).select(*key, "rule", "cut", "step")
    # The step at which a good document is first rejected, by any rule.
    places = steps.groupBy(*key).agg(F.expr("transform(array_sort(collect_list(struct(rule, cut, step))), x -> x.step)").alias("places"))
    first = F.least(*[F.expr(f"case when {name} > 0 then places[{rule * BINS} + {name} - 1] end") for rule, name in enumerate(names)])
    rejected = good.join(places, key).groupBy(*key, first.alias("step")).agg(F.sum("n").alias("n"))
    in_order = Window.partitionBy(*key).orderBy("step")
    strata = totals.agg(F.count("*").alias("strata"))  # the pooled one among them
    tests = steps.join(rejected, [*key, "step"], "left").withColumn("rejected", F.sum(F.coalesce("n", F.lit(0))).over(in_order))
    tests = tests.join(totals, key).crossJoin(F.broadcast(strata))
    tests = tests.withColumn("proven", F.when(F.col("rejected") >= F.col("total") * risk, False).otherwise(binomial_tail("rejected", "total", f"{risk!r}D") <= F.lit(error) / F.col("strata")))
    held = tests.withColumn("held", F.min(F.col("proven").cast("int")).over(in_order)).where("held = 1")
    cuts = held.groupBy(*key).agg(*[F.min(F.when(F.col("rule") == rule, F.col("cut"))).alias(f"cut_{name}") for rule, name in enumerate(names)])
    too_few = totals.where("not pooled").crossJoin(F.broadcast(strata)).where(F.pow(F.lit(1 - risk), "total") > F.lit(error) / F.col("strata")).select("stratum")
    fallen_back = too_few.crossJoin(F.broadcast(cuts.where("pooled").drop(*key)))
    return cuts.where("not pooled").drop("pooled").unionByName(fallen_back)


def _bin(score: Column) -> Column:
    return F.least(F.lit(BINS), F.floor(score * BINS)).cast("int")


def judge(measured: DataFrame, cutoffs: DataFrame, stratum: str = "lang") -> DataFrame:
    """Add ``base_failed`` and ``kept`` (false where a score reaches its stratum's cutoff); ``cutoffs`` has a row per stratum."""
    key = F.coalesce(measured[stratum].cast("string"), F.lit(""))
    joined = measured.join(cutoffs, key == cutoffs["stratum"], "left")
    over = F.lit(False)
    for name, score in RULES.items():
        over = over | F.coalesce(_bin(score()) >= F.col(f"cut_{name}"), F.lit(False))
    joined = joined.withColumn("base_failed", base_failed())
    return joined.withColumn("kept", ~F.col("base_failed") & ~over).drop("stratum", *[f"cut_{name}" for name in RULES])

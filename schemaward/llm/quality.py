"""Quality rules whose cutoffs are certified on labelled holdouts. DataFrame functions only.

Each rule rejects a document at or above a cutoff of one share. Half of the labelled documents propose the cutoffs of a
stratum, the other half must certify them: the exact binomial bound on the share of good documents that they reject has
to stay within ``alpha``, at a level divided by the number of strata.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from schemaward.llm.batches import fresh, store

WHITE = r"[\x20\x09-\x0D]+"
RULES = ("symbol_share", "upper_share", "mark_share", "dup_line_share", "stutter_share")
CUTOFFS = tuple(round(0.02 * k, 2) for k in range(1, 41))
FACTORS = (1.0, 1.1, 1.25, 1.5, 2.0, 3.0)  # what a proposed cutoff is multiplied by until the holdout certifies it
FALSE_REJECT_COST = 20    # low-quality documents that one rejected good document outweighs when a cutoff is proposed
STRATA_BROADCAST = 10_000  # strata up to which the cutoffs are broadcast; more are joined by shuffle
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
ADDED = (*BASE, *RULES, "base_failed", "failed_rules", "kept")


def measure(docs: DataFrame, text: str = "text", window: int = 8) -> DataFrame:
    """``docs`` with the counts of BASE, the shares of RULES and base_failed.

    Null and empty texts count zero everywhere and fail for want of words. n_repeat_words counts the words in
    ``window``-word windows found twice or more in the text; windows are first compared by 64-bit hashes in the row,
    only rows with an equal pair are sorted, so no row leaves its place.
    """
    w, h, s, upper, marks, n_lines, stutter = (fresh(docs.columns, x) for x in ("_words", "_hashes", "_sorted", "_upper", "_marks", "_n_lines", "_stutter"))
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    out = docs.drop(*ADDED).withColumn(w, F.filter(F.split(whole, WHITE), lambda x: x != ""))
    lines = F.filter(F.split(whole, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    n, chars = F.size(w), F.length(F.array_join(w, ""))
    windows = F.when(n >= window, F.transform(F.sequence(F.lit(1), n - (window - 1)), lambda i: F.xxhash64(F.slice(F.col(w), i, window))))
    ln = fresh(docs.columns, "_lines")
    out = out.withColumns({
        "n_words": n.cast("long"), "word_chars": chars.cast("long"), "n_symbols": F.regexp_count(whole, F.lit(r"[#*$%&|<>]")).cast("long"),
        stutter: F.size(F.filter(w, lambda x, i: (i > 0) & (F.col(w)[F.greatest(i - 1, F.lit(0))] == x))), upper: F.regexp_count(whole, F.lit(r"\p{Lu}")), marks: F.regexp_count(whole, F.lit("[!?]")), ln: lines, h: windows,
    })
    out = out.withColumns({
        "n_dup_lines": (F.size(ln) - F.size(F.array_distinct(ln))).cast("long"), n_lines: F.size(ln),
        s: F.when(F.size(F.array_distinct(h)) < F.size(h), F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))),
    }).drop(w, ln, h)
    at = F.col(s)
    twice = F.filter(at, lambda e, k: ((k > 0) & (at[F.greatest(k - 1, F.lit(0))]["h"] == e["h"])) | ((k < F.size(at) - 1) & (at[F.least(k + 1, F.size(at) - 1)]["h"] == e["h"])))
    covered = F.aggregate(F.array_sort(F.transform(twice, lambda e: e["i"])), F.struct(F.lit(0).cast("long").alias("n"), F.lit(-window).alias("last")),
                          lambda a, x: F.struct((a["n"] + F.least(F.lit(window), x - a["last"])).alias("n"), x.alias("last")), lambda a: a["n"])
    out = out.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("long"))).drop(s)
    share = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0)
    return out.withColumns({
        "symbol_share": share("n_symbols", "word_chars"), "upper_share": share(upper, "word_chars"), "mark_share": share(marks, "word_chars"),
        "stutter_share": share(stutter, "n_words"), "dup_line_share": share("n_dup_lines", n_lines), "base_failed": (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words")),
    }).drop(upper, marks, n_lines, stutter)


def _log_cdf(k: Column, n: Column, p: Column) -> Column:
    """Natural logarithm of P(X <= k) for X binomial (n, p), summed term by term in log space."""
    def add(a, j):
        term = a["term"] + F.log((n - j + 1) / j) + F.log(p / (1 - p))
        top = F.greatest(a["sum"], term)
        return F.struct(term.alias("term"), (top + F.log1p(F.exp(-F.abs(a["sum"] - term)))).alias("sum"))
    first = n * F.log(1 - p)
    return F.when(k <= 0, first).otherwise(F.aggregate(F.sequence(F.lit(1).cast("long"), F.greatest(k, F.lit(1))), F.struct(first.alias("term"), first.alias("sum")), add, lambda a: a["sum"]))


def certified_cutoffs(labelled: DataFrame, alpha: float = 0.03, delta: float = 0.05) -> DataFrame:
    """(stratum, cutoffs: map of rule to cutoff) from rows of stratum, good (0 or 1), holdout and the shares of RULES.

    The fit half proposes a cutoff for each rule that rejects low-quality documents at little cost in good ones. The
    holdout tests all rules of a stratum together, with the cutoffs multiplied by FACTORS from the largest down; such
    rejections are nested, so this fixed order needs no correction of its own, and the level of a test is delta over
    the number of strata. A factor passes if, were the true share of rejected good documents alpha, so few rejections
    had at most that chance, summed exactly. With probability 1 - ``delta`` no stratum loses more than ``alpha`` of its
    good documents. Strata with too few labels certify nothing and reject nothing.
    """
    every = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.col(r).alias("value")) for r in RULES])).alias("r")
    level = sum((F.col("r.value") >= c).cast("int") for c in CUTOFFS)
    # one row for each level at most, however many documents
    counts = labelled.where("not holdout").select("stratum", "good", every).groupBy("stratum", F.col("r.rule").alias("rule"), level.alias("level")).agg(
        F.sum("good").alias("good"), F.sum(1 - F.col("good")).alias("bad"))
    worth = counts.where("level > 0").select("stratum", "rule", "level", (F.col("bad") - FALSE_REJECT_COST * F.col("good")).alias("gain"))
    worth = worth.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("level")))).groupBy("stratum", "rule", "cut").agg(F.sum("gain").alias("gain"))
    best = worth.groupBy("stratum", "rule").agg(F.max("gain").alias("gain"), F.max_by("cut", F.struct("gain", "cut")).alias("cut")).where("gain > 0")
    value = F.element_at(F.array(*[F.lit(c) for c in CUTOFFS]), F.col("cut"))
    proposed = store(best.groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("rule", value))).alias("cutoffs")), "proposed")
    strata = max(1, proposed.count())
    side = proposed.select(F.col("stratum").alias("s"), "cutoffs")
    held = labelled.where("holdout and good = 1").join(F.broadcast(side) if strata <= STRATA_BROADCAST else side, F.col("stratum").eqNullSafe(F.col("s")))
    worst = F.array_max(F.array(*[F.col(r) / F.col("cutoffs")[r] for r in RULES]))
    tested = held.groupBy("stratum").agg(F.count(F.lit(1)).alias("n"), F.array(*[F.sum(F.when(worst >= t, 1).otherwise(0)) for t in FACTORS]).alias("k"))
    tested = tested.select("stratum", "n", F.posexplode("k").alias("at", "k")).where(F.col("k") < F.col("n") * alpha)
    passed = tested.where(_log_cdf(F.col("k"), F.col("n"), F.lit(alpha)) <= F.log(F.lit(delta / strata)))
    chosen = passed.groupBy(F.col("stratum").alias("s")).agg(F.element_at(F.array(*[F.lit(t) for t in FACTORS]), F.min("at") + 1).alias("factor"))
    out = proposed.join(chosen, F.col("stratum").eqNullSafe(F.col("s")))
    return out.select("stratum", F.transform_values("cutoffs", lambda _, v: v * F.col("factor")).alias("cutoffs"))


def fit_cutoffs(measured: DataFrame, labels: DataFrame, stratum: str = "lang", key: str = "doc_id", alpha: float = 0.03, delta: float = 0.05) -> DataFrame:
    """(stratum, cutoffs) from measured documents and their labels (``key``, quality).

    Labels of one key count once, with their lowest quality; null keys, labels other than 0 and 1 and labels without a
    document count nothing. Only the shares meet the labels, never a text.
    """
    marks = labels.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("label_key")).agg(F.min("quality").alias("good")).where(F.col("good").isin(0, 1))
    shares = measured.select(F.col(f"`{key}`").alias("key"), F.col(f"`{stratum}`").alias("stratum"), *RULES)
    labelled = shares.join(marks, F.col("key") == F.col("label_key")).select(
        "stratum", "good", (F.crc32(F.col("key").cast("string").cast("binary")) % 2 == 0).alias("holdout"), *RULES)
    return store(certified_cutoffs(store(labelled, "labelled"), alpha, delta), "cutoffs")


def judge(measured: DataFrame, cutoffs: DataFrame, stratum: str = "lang") -> DataFrame:
    """``measured`` with failed_rules (names) and kept; strata without cutoffs meet the base rules alone."""
    cs, cc = fresh(measured.columns, "_cs"), fresh(measured.columns, "_cc")
    side = cutoffs.select(F.col("stratum").alias(cs), F.col("cutoffs").alias(cc))
    if cutoffs.count() <= STRATA_BROADCAST:
        side = F.broadcast(side)
    out = measured.join(side, F.col(f"`{stratum}`").eqNullSafe(F.col(cs)), "left")
    failed = F.filter(F.array(*[F.when(F.col(r) >= F.col(cc)[r], F.lit(r)) for r in RULES]), lambda x: x.isNotNull())
    return out.withColumn("failed_rules", failed).withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0)).drop(cs, cc)


def apply_rules(docs: DataFrame, labels: DataFrame, text: str = "text", stratum: str = "lang", key: str = "doc_id", keep_text: bool = True) -> DataFrame:
    """``docs`` with measures, base_failed, failed_rules (names) and kept.

    The measures of all documents are written without their texts and fitted on; with ``keep_text`` the texts are
    measured again for the result, which costs less than to move them. A null stratum is one of its own. Without labels
    only the base rules reject; repeated rows are judged alike. Columns of an added name are replaced, others pass
    through.
    """
    measured = store(measure(docs, text).drop(text), "measured")
    cutoffs = fit_cutoffs(measured, labels, stratum, key)
    return judge(measure(docs, text) if keep_text else measured, cutoffs, stratum)


def kept_documents(docs: DataFrame, labels: DataFrame, text: str = "text", stratum: str = "lang", key: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that ``apply_rules`` keeps, with their own columns but those of an added name.

    Texts are written once beside their measures, so every text is measured once and the filter reads stored columns.
    """
    measured = store(measure(docs.drop(*ADDED), text), "measured")
    judged = judge(measured, fit_cutoffs(measured, labels, stratum, key), stratum)
    return judged.where("kept").select([f"`{c}`" for c in docs.columns if c.lower() not in ADDED])

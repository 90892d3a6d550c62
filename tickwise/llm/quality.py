"""Quality rules as a bitmask ledger, in built-in functions only.

``ledger`` measures each document once and evaluates every rule once; the
failures are bits of one integer, stored beside the measurements. Policies are
versioned masks applied to that integer (``apply_policy``), and ``ablation``
answers "how many documents would version X keep without rule R" from counts
per distinct mask, of which there are at most two to the number of rules:
neither reads a text again.

Defined cases: a null text has no words and no characters; empty text
likewise (both fail ``few_words``); repeated rows are judged each on its own;
null ids and other columns pass through untouched. Columns of the input that
have the name of a ledger column are replaced by it. Texts are read whole.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACES = " \t\n\x0b\f\r"
SPACE_RUN = "[ \\t\\n\\x0B\\f\\r]+"
SYMBOLS = "#*$%&|<>"

MIN_WORDS = 50

# Bit i of ``failures`` is rule i; the order is part of stored ledgers.
RULES: dict[str, str] = {
    "few_words": f"n_words < {MIN_WORDS}",
    "repeated_windows": "100 * n_repeat_words > 50 * n_words",
    "symbols": "100 * n_symbols > 20 * n_words",
    "exclamations": "100 * n_exclamations > 30 * n_words",
    "duplicate_lines": "100 * n_dup_lines > 70 * n_lines",
    "word_length": "word_chars > 15 * n_words or word_chars < 2 * n_words",
}
BASE = ("few_words", "repeated_windows")
POLICIES: dict[str, tuple[str, ...]] = {
    "base": BASE,
    "v1": (*BASE, "symbols", "exclamations"),
    "v2": (*BASE, "symbols", "exclamations", "duplicate_lines", "word_length"),
}
CURRENT = "v2"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_exclamations", "n_lines", "n_dup_lines", "n_repeat_words")


def bits(rules: tuple[str, ...]) -> int:
    order = list(RULES)
    return sum(1 << order.index(r) for r in rules)


def _count(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def _repeat_words(grams: Column) -> Column:
    """Words in windows of three found twice or more, from the hashes of the
    windows in order. Windows are sorted with their places; neighbours with
    equal hashes give the places of repeated windows; overlaps count once."""
    placed = F.sort_array(F.transform(grams, lambda g, i: F.struct(g.alias("h"), i.alias("p"))))

    def pairs(s: Column) -> Column:
        return F.zip_with(
            s, F.slice(s, 2, F.size(s)), lambda x, y: F.when(x["h"] == y["h"], F.array(x["p"], y["p"]))
        )

    # a one-element array binds ``placed`` once for both uses
    equal = F.transform(F.array(placed), pairs)[0]
    places = F.sort_array(F.array_distinct(F.flatten(F.filter(equal, lambda z: z.isNotNull()))))
    return F.aggregate(
        places,
        F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n")),
        lambda a, p: F.struct(p.alias("last"), (a["n"] + F.least(F.lit(3), p - a["last"])).alias("n")),
        lambda a: a["n"],
    )


def ledger(docs: DataFrame, text_col: str = "text", nested: bool = False) -> DataFrame:
    """``docs`` with the measurements and ``failures`` (one bit a rule). With
    ``nested`` the document is one column ``row`` and loses none of its own
    columns to ledger columns of the same name."""
    kept = [F.col(f"`{c}`") for c in docs.columns if nested or c not in (*MEASURES, "failures")]
    carried = F.struct(*kept).alias("row")
    text = F.coalesce(F.col(text_col), F.lit(""))
    step = docs.select(carried, text.alias("t"), F.array_remove(F.split(text, SPACE_RUN), "").alias("w"))
    step = step.select("row", "t", "w", F.transform("w", lambda x: F.xxhash64(x)).alias("h"))
    pair = F.zip_with("h", F.expr("slice(h, 2, size(h))"), lambda a, b: F.xxhash64(a, b))
    triple = F.zip_with(pair, F.expr("slice(h, 3, size(h))"), lambda a, b: F.xxhash64(a, b))
    step = step.select(
        "row",
        "t",
        F.size("w").alias("n"),
        F.when(F.size("h") >= 3, F.slice(triple, 1, F.size("h") - 2)).alias("g"),
        F.split("t", "\n").alias("lines"),
    )
    step = step.select(
        "row",
        "t",
        "n",
        "g",
        F.size("lines").alias("n_lines"),
        F.filter("lines", lambda x: F.translate(x, SPACES, "") != "").alias("full"),
    )
    repeated = F.when(
        F.col("g").isNotNull() & (F.size(F.array_distinct("g")) < F.size("g")), _repeat_words(F.col("g"))
    ).otherwise(F.lit(0))
    measured = step.select(
        "row",
        F.col("n").cast("long").alias("n_words"),
        F.length(F.translate("t", SPACES, "")).cast("long").alias("word_chars"),
        _count(F.col("t"), SYMBOLS).cast("long").alias("n_symbols"),
        _count(F.col("t"), "!").cast("long").alias("n_exclamations"),
        F.col("n_lines").cast("long").alias("n_lines"),
        (F.size("full") - F.size(F.array_distinct("full"))).cast("long").alias("n_dup_lines"),
        repeated.cast("long").alias("n_repeat_words"),
    )
    failures = reduce(
        lambda a, b: a.bitwiseOR(b),
        [F.when(F.expr(rule), F.lit(1 << i)).otherwise(F.lit(0)) for i, rule in enumerate(RULES.values())],
    )
    return measured.select("row" if nested else "row.*", *MEASURES, failures.alias("failures"))


def passes(version: str = CURRENT, failures: str = "failures") -> Column:
    """True where no rule of the version's policy failed."""
    return F.col(failures).bitwiseAND(F.lit(bits(POLICIES[version]))) == 0


def apply_policy(rows: DataFrame, version: str = CURRENT, column: str = "kept") -> DataFrame:
    """A ledger with the version's verdict as ``column``."""
    return rows.withColumn(column, passes(version))


def ablation(rows: DataFrame, version: str = CURRENT) -> DataFrame:
    """One row per rule of the policy: documents that fail it, that fail it
    alone (they would stay without it), and that the whole policy keeps."""
    masks = rows.groupBy("failures").agg(F.count(F.lit(1)).alias("n"))
    policy = bits(POLICIES[version])
    one = F.expr("shiftleft(1, bit)")
    rules = F.explode(
        F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(list(RULES).index(r)).alias("bit")) for r in POLICIES[version]])
    )
    failed = F.col("failures").bitwiseAND(F.lit(policy))
    return (
        masks.select("failures", "n", rules.alias("r"))
        .select("failures", "n", "r.rule", "r.bit")
        .groupBy("rule")
        .agg(
            F.sum(F.when(failed.bitwiseAND(one) != 0, F.col("n")).otherwise(0)).alias("n_failed"),
            F.sum(F.when(failed == one, F.col("n")).otherwise(0)).alias("n_only"),
            F.sum(F.when(failed == 0, F.col("n")).otherwise(0)).alias("n_kept"),
        )
    )

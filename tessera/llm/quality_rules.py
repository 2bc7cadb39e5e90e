"""Quality rules as a bitmask ledger (DataFrame functions only).

``ledger`` evaluates every rule once for each document and stores the failures as bits of one long beside the
measurements. ``apply_policy`` turns ledger rows into verdicts under a versioned policy, which names the rules that count;
``ablation`` tells from the ledger alone, by bitwise aggregation, what each rule of a policy removes.

Null and empty texts have no words: all measurements are 0 and the length rule fails. Repeated rows are judged one by one.
Only ``id_col`` and ``text_col`` are read, so extra columns can have any names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, words

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_exclaim")

#: Rules in the order of their bits. Integer arithmetic only, so every engine agrees.
RULES: dict[str, str] = {
    "too_short": "n_words < 50",
    "repeated_trigrams": "100 * n_repeat_words > 50 * n_words",
    "symbol_heavy": "10 * n_symbols > 2 * n_words",
    "shouting": "10 * n_exclaim > 4 * n_words",
    "duplicate_lines": "n_lines >= 4 and 10 * n_dup_lines > 5 * n_lines",
    "word_length": "n_words > 0 and (word_chars < 2 * n_words or word_chars > 12 * n_words)",
}
BASE = ("too_short", "repeated_trigrams")


@dataclass(frozen=True)
class Policy:
    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(1 << list(RULES).index(r) for r in self.rules)


POLICIES = {p.version: p for p in (Policy("base", BASE), Policy("v1", tuple(RULES)), Policy("v1-no-length", tuple(r for r in RULES if r != "word_length")))}
PRODUCTION = "v1"


def _count_of(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


def _repeat_words(w: Column) -> Column:
    """Words covered by three-word windows that occur twice or more.

    The windows are sorted by (hash, words, position) within the row, so equal ones are neighbours; n log n in the length
    of the text, whatever it repeats.
    """

    def windows(w: Column) -> Column:
        return F.sort_array(F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.struct(F.xxhash64(w[i], w[i + 1], w[i + 2]).alias("h"), w[i].alias("a"), w[i + 1].alias("b"), w[i + 2].alias("c"), i.alias("p"))))

    def same(x: Column, y: Column) -> Column:
        return F.coalesce((x["h"] == y["h"]) & (x["a"] == y["a"]) & (x["b"] == y["b"]) & (x["c"] == y["c"]), F.lit(False))

    def repeated(s: Column) -> Column:
        return F.filter(s, lambda x, i: same(x, F.get(s, i - 1)) | same(x, F.get(s, i + 1)))

    def covered(g: Column) -> Column:
        at = F.sort_array(F.transform(g, lambda x: x["p"]))
        return F.aggregate(at, F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")), lambda a, p: F.struct((a["n"] + F.least(F.lit(3), p - a["last"])).alias("n"), p.alias("last")), lambda a: a["n"])

    return F.when(F.size(w) < 3, F.lit(0)).otherwise(covered(let(windows(w), repeated)))


def measures(text: Column) -> Column:
    """A struct of MEASURES for a text column."""
    t = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: F.length(F.translate(x, " \t\n\x0b\x0c\r", "")) > 0)

    def of_words(w: Column) -> Column:
        return F.struct(F.size(w).cast("long").alias("n_words"), _repeat_words(w).cast("long").alias("n_repeat_words"))

    def of_lines(x: Column) -> Column:
        return F.struct(F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"))

    return let(
        F.struct(let(words(t), of_words).alias("w"), let(lines, of_lines).alias("l")),
        lambda m: F.struct(
            m["w"]["n_words"].alias("n_words"),
            F.length(F.translate(t, " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
            _count_of(t, "#*$%&|<>").cast("long").alias("n_symbols"),
            m["l"]["n_dup_lines"].alias("n_dup_lines"),
            m["w"]["n_repeat_words"].alias("n_repeat_words"),
            m["l"]["n_lines"].alias("n_lines"),
            _count_of(t, "!").cast("long").alias("n_exclaim"),
        ),
    )


def fail_bits() -> Column:
    """The failures of a row that has the MEASURES as columns."""
    bits = F.lit(0).cast("long")
    for k, rule in enumerate(RULES.values()):
        bits = bits.bitwiseOR(F.when(F.expr(rule), F.lit(1 << k).cast("long")).otherwise(F.lit(0).cast("long")))
    return bits


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """One row for each document: id_col, the columns in keep, MEASURES and fail_bits."""
    keep = keep or []
    rows = docs.select(F.col(id_col), *keep, measures(F.col(text_col)).alias("__m"))
    named = rows.select(F.struct(id_col, *keep).alias("__row"), "__m.*")
    return named.select("__row.*", *MEASURES, fail_bits().alias("fail_bits"))


def failed(bits: Column, policy: Policy) -> Column:
    return bits.bitwiseAND(F.lit(policy.mask).cast("long")) != 0


def apply_policy(rows: DataFrame, version: str = PRODUCTION) -> DataFrame:
    """Ledger rows with kept and policy_version."""
    return rows.withColumns({"kept": ~failed(F.col("fail_bits"), POLICIES[version]), "policy_version": F.lit(version)})


def ablation(rows: DataFrame, version: str = PRODUCTION) -> DataFrame:
    """For each rule of a policy: documents that fail it, that fail it alone, and that would be kept without it.

    Documents are first counted by their failure bits: at most 2^len(RULES) groups go on, whatever the input.
    """
    policy = POLICIES[version]
    by_bits = rows.groupBy(F.col("fail_bits").bitwiseAND(F.lit(policy.mask).cast("long")).alias("bits")).agg(F.count("*").alias("n"))
    rule = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(1 << list(RULES).index(r)).cast("long").alias("bit")) for r in policy.rules]))
    return (
        by_bits.select("bits", "n", rule.alias("r"))
        .groupBy(F.col("r.rule").alias("rule"))
        .agg(
            F.sum(F.when(F.col("bits").bitwiseAND(F.col("r.bit")) != 0, F.col("n")).otherwise(0)).alias("n_failed"),
            F.sum(F.when(F.col("bits") == F.col("r.bit"), F.col("n")).otherwise(0)).alias("n_failed_alone"),
            F.sum(F.when(F.col("bits").bitwiseAND(F.bitwise_not(F.col("r.bit"))) == 0, F.col("n")).otherwise(0)).alias("n_kept_without"),
        )
    )


def filter_documents(docs: DataFrame, version: str = PRODUCTION, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that the policy keeps, with their own columns."""
    m = docs.select(F.struct(*docs.columns).alias("__doc"), measures(F.col(text_col)).alias("__m"))
    m = m.select("__doc", "__m.*").where(~failed(fail_bits(), POLICIES[version]))
    return m.select("__doc.*")

"""Quality rules as a ledger: every rule is evaluated once, policies are applied to stored bits.

The ledger holds, for each document, the measurements and one bit for each rule that it fails. A
policy is a version with a mask of the rules that it enforces. Applying another policy, or asking what
a rule alone costs, reads the bits and never the text. All of it is DataFrame functions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: White space that ends a word: tab to carriage return, and the blank.
SPACES = "\t\n\x0b\x0c\r "
SYMBOLS = "[#*$%&|<>]"
NOT_WORD = r"[\x20\x09-\x0D]+"
A_WORD = r"[^\x20\x09-\x0D]"


@dataclass(frozen=True)
class Rule:
    """failed: an SQL condition on the measurements, never null. Its bit never changes."""

    bit: int
    name: str
    failed: str


@dataclass(frozen=True)
class Policy:
    version: str
    rules: tuple[str, ...]


#: Shares are compared as products of whole numbers, so that every engine agrees.
RULES = (
    Rule(0, "few_words", "n_words < 50"),
    Rule(1, "repeated_words", "100 * n_repeat_words > 50 * n_words"),
    Rule(2, "short_words", "word_chars < 2 * n_words"),
    Rule(3, "long_words", "word_chars > 16 * n_words"),
    Rule(4, "symbols", "10 * n_symbols > 3 * n_words"),
    Rule(5, "repeated_lines", "2 * n_dup_lines > n_lines"),
    Rule(6, "upper_case", "2 * n_upper > word_chars"),
    Rule(7, "shouting", "10 * n_exclaimed > 3 * n_words"),
)
BASE = Policy("base", ("few_words", "repeated_words"))
STRICT = Policy("2", tuple(r.name for r in RULES))


def bound(value: Column, use) -> Column:
    """use(x) with value computed once, however often use() names x, also inside a lambda."""
    return F.element_at(F.transform(F.array(value), use), 1)


def repeated_words(words: Column) -> Column:
    """How many words lie in a window of three that is found twice or more.

    Windows are sorted by their words, so that equal ones are neighbours; of those that are repeated,
    each covers three words, less those that the next one covers as well."""

    def covered(places: Column) -> Column:
        return F.aggregate(
            places,
            F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
            lambda s, p: F.struct(
                (s["n"] + F.least(F.lit(3), p - s["last"])).alias("n"), p.alias("last")
            ),
            lambda s: s["n"],
        )

    def repeats(sorted_windows: Column) -> Column:
        def twin(x: Column, i: Column) -> Column:
            # get() gives null outside the array
            return F.coalesce(F.get(sorted_windows, i - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(
                F.get(sorted_windows, i + 1)["h"] == x["h"], F.lit(False)
            )

        return covered(F.sort_array(F.transform(F.filter(sorted_windows, twin), lambda x: x["i"])))

    def sorted_windows(hashes: Column) -> Column:
        placed = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        some = F.size(F.array_distinct(hashes)) < F.size(hashes)
        return F.when(some, bound(F.sort_array(placed), repeats)).otherwise(0)

    def windows(w: Column) -> Column:
        hashes = F.transform(
            F.slice(w, 3, F.size(w) - 2),
            lambda third, i: F.xxhash64(F.get(w, i), F.get(w, i + 1), third),
        )
        return bound(hashes, sorted_windows)

    return F.when(F.size(words) >= 4, bound(words, windows)).otherwise(0)


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with the measurements as long columns, all over the whole text (null: empty).

    n_words, n_lines (with a word), word_chars and n_upper (code points, the latter of A-Z), n_symbols,
    n_exclaimed (exclamation marks), n_dup_lines, n_repeat_words. Columns of these names go.
    """
    raw = F.coalesce(F.col(text), F.lit(""))
    inner = F.btrim(raw, F.lit(SPACES))
    words = F.when(inner != "", F.split(inner, NOT_WORD)).otherwise(F.array().cast("array<string>"))
    lines = F.filter(F.split(raw, "\n"), lambda line: line.rlike(A_WORD))
    docs = docs.withColumns({"_words": words, "_lines": lines})

    def found(characters: str) -> Column:
        return F.regexp_count(raw, F.lit(characters))

    counts = {
        "n_words": F.size("_words"),
        "n_lines": F.size("_lines"),
        "word_chars": F.char_length(F.array_join("_words", "")),
        "n_upper": found("[A-Z]"),
        "n_symbols": found(SYMBOLS),
        "n_exclaimed": found("!"),
        "n_dup_lines": F.size("_lines") - F.size(F.array_distinct("_lines")),
        "n_repeat_words": repeated_words(F.col("_words")),
    }
    docs = docs.withColumns({name: value.cast("long") for name, value in counts.items()})
    return docs.drop("_words", "_lines")


def ledger(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """measured() with failed_bits: bit b of the long is 1 if the rule with bit b is failed."""
    bits = F.lit(0).cast("long")
    for rule in rules:
        bits = bits.bitwiseOR(F.when(F.expr(rule.failed), 1 << rule.bit).otherwise(0).cast("long"))
    return measured(docs, text).withColumn("failed_bits", bits)


def enforced(policy: Policy, rules: tuple[Rule, ...] = RULES) -> int:
    bits = {rule.name: 1 << rule.bit for rule in rules}
    return sum(bits[name] for name in policy.rules)


def fails(policy: Policy, rules: tuple[Rule, ...] = RULES) -> Column:
    """Whether a ledger's row fails a rule that the policy enforces."""
    return F.col("failed_bits").bitwiseAND(F.lit(enforced(policy, rules)).cast("long")) != 0


def ablations(rows: DataFrame, policy: Policy, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(version, rule, n_failed, n_only, n_kept_without) of a policy's rules, from a ledger's bits.

    n_only: rows that this rule alone rejects; n_kept_without: rows that are kept without the rule.
    The bits are first counted by value, of which there are few. An empty ledger counts 0.
    """
    mask = enforced(policy, rules)
    counted = rows.select(
        F.col("failed_bits").bitwiseAND(F.lit(mask).cast("long")).alias("bits")
    ).groupBy("bits").agg(F.count("*").alias("n"))

    def rows_with(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0)).cast("long")

    own = [rule for rule in rules if rule.name in policy.rules]
    parts = []
    for rule in own:
        bit, rest = F.lit(1 << rule.bit).cast("long"), F.lit(mask & ~(1 << rule.bit)).cast("long")
        parts.append(
            F.struct(
                F.lit(policy.version).alias("version"),
                F.lit(rule.name).alias("rule"),
                rows_with(F.col("bits").bitwiseAND(bit) != 0).alias("n_failed"),
                rows_with(F.col("bits") == bit).alias("n_only"),
                rows_with(F.col("bits").bitwiseAND(rest) == 0).alias("n_kept_without"),
            )
        )
    return counted.agg(F.array(*parts).alias("rules")).select(F.inline("rules"))

"""Text rules, their failure rates per host, and verdicts that join both."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from steploom.session import materialize

from .common import let, spare_name, words

SYMBOL = "[#*$%&|<>]"
NOT_SPACE = "[^\\x20\\x09-\\x0D]"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")


@dataclass(frozen=True)
class HostRules:
    """Limits of the text rules and of the hosts.

    ``max_rate``: a host is refused if its shrunken failure rate of a rule is above this.
    ``weak_prior``: weight of the prior, in documents, where hosts do not differ measurably.
    """

    min_words: int = 50
    max_repeat_percent: int = 50
    max_symbol_percent: int = 30
    max_dup_line_percent: int = 50
    max_rate: float = 0.8
    weak_prior: float = 1000.0


def _repeated_words(w: Column) -> Column:
    """Words in windows of three that occur at least twice in ``w``.

    Windows are sorted by a hash and then by their words, equal neighbours are repeats, and the places of repeats
    cover three words each, less where they overlap.
    """

    def places(sorted_windows: Column) -> Column:
        one = lambda j, k: sorted_windows[j][k] == sorted_windows[j - 1][k]
        same = lambda j: one(j, "h") & one(j, "a") & one(j, "b") & one(j, "c")
        n = F.size(sorted_windows)
        repeated = F.filter(
            F.sequence(F.lit(0), n - 1), lambda j: F.when(j > 0, same(j)).otherwise(False) | F.when(j < n - 1, same(j + 1)).otherwise(False)
        )
        return F.sort_array(F.transform(repeated, lambda j: sorted_windows[j]["at"]))

    def covered(at: Column) -> Column:
        steps = F.transform(at, lambda p, k: F.when(k > 0, F.least(p - at[k - 1], F.lit(3))).otherwise(3))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda total, step: total + step)

    windows = F.transform(
        F.sequence(F.lit(0), F.size(w) - 3),
        lambda i: F.struct(
            F.xxhash64(w[i], w[i + 1], w[i + 2]).alias("h"), w[i].alias("a"), w[i + 1].alias("b"), w[i + 2].alias("c"), i.alias("at")
        ),
    )
    return F.when(F.size(w) < 4, F.lit(0).cast("long")).otherwise(
        let(F.sort_array(windows), lambda s: let(places(s), covered))
    )


def text_counts(text: Column) -> Column:
    """Struct of ``COUNTS`` for a text; all 0 for NULL."""
    full = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(full, "\n"), lambda line: line.rlike(NOT_SPACE))
    return let(
        words(full),
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.aggregate(w, F.lit(0).cast("long"), lambda total, word: total + F.length(word)).alias("word_chars"),
            (F.length(full) - F.length(F.regexp_replace(full, SYMBOL, ""))).cast("long").alias("n_symbols"),
            let(lines, lambda own: F.size(own) - F.size(F.array_distinct(own))).cast("long").alias("n_dup_lines"),
            _repeated_words(w).alias("n_repeat_words"),
            F.size(lines).cast("long").alias("n_lines"),
        ),
    )


def failures(counts: Column, rules: HostRules) -> dict[str, Column]:
    """What each rule says: true where the text fails it."""
    share = lambda part, whole, percent: 100 * part > percent * whole
    return {
        "short": counts["n_words"] < rules.min_words,
        "repeats": share(counts["n_repeat_words"], counts["n_words"], rules.max_repeat_percent),
        "symbols": share(counts["n_symbols"], counts["word_chars"], rules.max_symbol_percent),
        "dup_lines": share(counts["n_dup_lines"], counts["n_lines"], rules.max_dup_line_percent),
    }


#: The rules that refuse a document by itself; the others count against its host only.
BASE_RULES = ("short", "repeats")


def host_verdicts(counted: DataFrame, rules: HostRules) -> DataFrame:
    """``host``, ``n_docs`` and ``refused`` from rows of ``host`` and ``failed`` (struct of booleans per rule).

    The rate of a rule over hosts gets a beta prior by moments: its mean is the pooled
    rate, its weight follows from how far the hosts' rates spread beyond what chance
    gives.  A host's rate is shrunk to that mean, so a host with three documents is
    judged by the prior and one with thousands by itself.  Rows without a host are left out.
    """
    names = counted.schema["failed"].dataType.names
    hosts = counted.where(F.col("host").isNotNull()).groupBy("host").agg(
        F.count(F.lit(1)).alias("n_docs"),
        *[F.sum(F.col(f"failed.{r}").cast("long")).alias(f"k_{r}") for r in names],
    )
    moments = [F.sum("n_docs").alias("n"), F.count(F.lit(1)).alias("hosts")]
    for r in names:
        rate = F.col(f"k_{r}") / F.col("n_docs")
        moments += [F.sum(f"k_{r}").alias(f"k_{r}"), F.sum(F.col("n_docs") * rate * rate).alias(f"q_{r}")]
    total = hosts.agg(*moments).first()
    refused = F.lit(False)
    for r in names:
        mean, weight = _prior(total["n"] or 0, total["hosts"], total[f"k_{r}"] or 0, total[f"q_{r}"] or 0.0, rules)
        shrunk = (F.col(f"k_{r}") + F.lit(mean * weight)) / (F.col("n_docs") + F.lit(weight))
        refused = refused | (shrunk > rules.max_rate)
    return hosts.select("host", "n_docs", refused.alias("refused"))


def _prior(n: int, hosts: int, failed: int, squares: float, rules: HostRules) -> tuple[float, float]:
    """Mean and weight (alpha + beta) of the beta prior."""
    if not n:
        return 0.0, rules.weak_prior
    mean = failed / n
    chance = mean * (1 - mean)
    # Expected between-host sum of squares is (n - n/hosts) * spread + (hosts - 1) * chance.
    between = squares - n * mean * mean - (hosts - 1) * chance
    spread = between / (n - n / hosts) if hosts > 1 else 0.0
    if spread <= 0 or chance <= spread:
        return mean, rules.weak_prior if spread <= 0 else 1.0
    return mean, min(rules.weak_prior, max(1.0, chance / spread - 1))


def judge_documents(
    docs: DataFrame, rules: HostRules | None = None, text: str = "text", host: str = "source", columns: Sequence[str] | None = None
) -> tuple[DataFrame, str]:
    """All rows of ``docs`` with ``columns`` (by default all) and one more: a struct of ``COUNTS``, ``base_failed``, ``host_refused``, ``kept``.

    Returns the rows and the name of that column (``_judged``, or another if it is taken).
    Counts are written once, with the host and ``columns``, and read twice: for the hosts' failure rates and for the
    documents.  Host sums are combined before they are shuffled, and the verdict table
    has a row per host, so a host with a third of all documents is no hot spot.

    A NULL text has no words and fails as too short.  A NULL host is no host: such
    documents are judged by themselves.  Repeated rows count each.  No rows give no rows.
    """
    rules = rules or HostRules()
    name = spare_name(docs, "_judged")
    columns = list(docs.columns if columns is None else columns)
    own = [F.col(f"`{c}`") for c in columns + [host] * (host not in columns)]
    stored = materialize(docs.select(*own, text_counts(F.col(text)).alias(name)), "counted")
    failed = failures(F.col(name), rules)
    counted = stored.select(F.col(host).alias("host"), F.struct(*[c.alias(r) for r, c in failed.items()]).alias("failed"))
    # Stored, so that the planner knows how large the table is: where it is small, the texts are not shuffled.
    refused = materialize(host_verdicts(counted, rules).where("refused").select("host"), "refused")
    verdicts = refused.select(F.col("host").alias(f"{name}_host"))
    base = failed[BASE_RULES[0]]
    for r in BASE_RULES[1:]:
        base = base | failed[r]
    joined = stored.join(verdicts, F.col(host) == F.col(f"{name}_host"), "left")
    bad_host = F.col(f"{name}_host").isNotNull()
    judged = F.struct(
        *[F.col(name)[c].alias(c) for c in COUNTS],
        base.alias("base_failed"),
        bad_host.alias("host_refused"),
        (~base & ~bad_host).alias("kept"),
    )
    return joined.select(*[F.col(f"`{c}`") for c in columns], judged.alias(name)), name

"""Quality rules: learned decision lists over text measures, in DataFrame functions only."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import WORD
from tidemark.session import cut_lineage

SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WINDOW = 8
MEASURES = (
    "words", "word_length", "symbols", "marks", "capitals", "repeated", "distinct", "dup_lines",
)


def _count(text: Column, chars: str) -> Column:
    return (F.length(text) - F.length(F.translate(text, chars, ""))).cast("long")


def text_counts(docs: DataFrame) -> DataFrame:
    """Counts of every whole text, next to the other columns given; a null text counts as empty.

    ``n_repeat_words`` counts the words inside windows of eight words that the text holds at
    least twice. Windows are hashed; only a text whose hashes are not all distinct has them
    sorted with their positions, and equal neighbours give the places covered.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.translate(x, BLANKS, "")) > 0)
    others = [c for c in docs.columns if c != "text"]
    rows = docs.select(
        *others,
        F.length(F.translate(text, BLANKS, "")).cast("long").alias("word_chars"),
        _count(text, SYMBOLS).alias("n_symbols"),
        _count(text, "!?").alias("n_marks"),
        _count(text, CAPITALS).alias("n_capitals"),
        lines.alias("_lines"),
        F.regexp_extract_all(text, F.lit(WORD), F.lit(0)).alias("_words"),
    )
    counts = ["word_chars", "n_symbols", "n_marks", "n_capitals", "n_lines", "n_dup_lines", "n_words"]
    rows = rows.select(
        *others,
        *counts[:4],
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.size("_words").cast("long").alias("n_words"),
        F.transform("_words", lambda w: F.xxhash64(w)).alias("_w"),
    )
    window = F.transform(
        F.sequence(F.lit(0), (F.col("n_words") - WINDOW).cast("int")),
        lambda i: F.xxhash64(*(F.get("_w", i + j) for j in range(WINDOW))),
    )
    rows = rows.select(
        *others,
        *counts,
        F.size(F.array_distinct("_w")).cast("long").alias("n_distinct_words"),
        F.when(F.col("n_words") >= WINDOW, window).alias("_h"),
    )
    counts.append("n_distinct_words")
    rows = rows.select(
        *others,
        *counts,
        F.when(
            F.size(F.array_distinct("_h")) < F.size("_h"),
            F.sort_array(F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ).alias("_s"),
    )
    same = F.filter(
        "_s", lambda x, j: (x["h"] == F.get("_s", j - 1)["h"]) | (x["h"] == F.get("_s", j + 1)["h"])
    )
    rows = rows.select(*others, *counts, F.sort_array(F.transform(same, lambda x: x["i"])).alias("_p"))
    reach = F.transform("_p", lambda p, j: F.least(F.lit(WINDOW), F.coalesce(F.get("_p", j + 1) - p, F.lit(WINDOW))))
    covered = F.aggregate(reach, F.lit(0), lambda s, x: s + x)
    return rows.select(*others, *counts, F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"))


def measures() -> dict[str, Column]:
    """What rules may test, from the counts."""
    words = F.greatest(F.col("n_words"), F.lit(1))
    return {
        "words": F.col("n_words").cast("double"),
        "word_length": F.col("word_chars") / words,
        "symbols": F.col("n_symbols") / words,
        "marks": F.col("n_marks") / words,
        "capitals": F.col("n_capitals") / F.greatest(F.col("word_chars"), F.lit(1)),
        "repeated": F.col("n_repeat_words") / words,
        "distinct": F.col("n_distinct_words") / words,
        "dup_lines": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
    }


@dataclass(frozen=True)
class Condition:
    measure: str
    above: bool
    bound: float

    def test(self) -> Column:
        c = F.col(self.measure)
        return c > self.bound if self.above else c <= self.bound


Rule = tuple[Condition, ...]


def rule_test(rule: Rule) -> Column:
    return reduce(lambda a, b: a & b, (c.test() for c in rule))


def _bounds(rows: DataFrame, points: int) -> dict[str, list[float]]:
    """Quantiles of each measure among good and among bad rows, as candidate bounds."""
    at = [(i + 0.5) / points for i in range(points)]
    found = rows.groupBy("bad").agg(*(F.percentile_approx(m, at, 1000).alias(m) for m in MEASURES)).collect()
    return {m: sorted({float(x) for r in found for x in r[m] or []}) for m in MEASURES}


def _statistics(rows: DataFrame, bounds: dict[str, list[float]]) -> dict[str, dict[int, tuple[int, int]]]:
    """Bad and good rows by measure and interval between bounds."""

    def place(m: str) -> Column:
        below = F.filter(F.array(*map(F.lit, bounds[m])).cast("array<double>"), lambda b: b < F.col(m))
        return F.struct(F.lit(m).alias("m"), F.size(below).alias("at"))

    places = [place(m) for m in MEASURES]
    found = (
        rows.select("bad", F.explode(F.array(*places)).alias("p"))
        .groupBy("p.m", "p.at")
        .agg(F.sum("bad").alias("bad"), F.sum(1 - F.col("bad")).alias("good"))
        .collect()
    )
    out: dict[str, dict[int, tuple[int, int]]] = {m: {} for m in MEASURES}
    for r in found:
        out[r.m][r["at"]] = (r.bad, r.good)
    return out


def _best(rows: DataFrame, bounds: dict[str, list[float]], least: int) -> tuple[Condition, int, int] | None:
    """The condition of the best gain: bad rows kept times the growth of the log share of bad."""
    import math

    best, top = None, 0.0
    for m, counts in _statistics(rows, bounds).items():
        bad, good = sum(b for b, _ in counts.values()), sum(g for _, g in counts.values())
        if not bad:
            continue
        start = math.log2(bad / (bad + good))
        under = [0, 0]
        for i, bound in enumerate(bounds[m]):
            # interval i holds the values above bound i - 1, up to bound i itself
            b, g = counts.get(i, (0, 0))
            under[0] += b
            under[1] += g
            for above, (p, n) in ((False, tuple(under)), (True, (bad - under[0], good - under[1]))):
                if p >= least and (gain := p * (math.log2(p / (p + n)) - start)) > top + 1e-9:
                    best, top = (Condition(m, above, bound), p, n), gain
    return best


def learn(labelled: DataFrame, most_rules: int = 8, most_conditions: int = 3, points: int = 16, least: int = 5, share: float = 0.7) -> list[Rule]:
    """An ordered list of conjunctions that mark bad rows, by sequential covering.

    ``labelled`` is a written table with the measures, ``bad`` 0 or 1 and ``growing``. Each
    rule grows on two thirds of the rows, one condition of the best information gain at a time,
    from counts per interval of every measure. It is then pruned on the other third to the
    prefix of the best (bad - good) / (bad + good). A rule stays if at least ``share`` of what
    it marks there is bad; what it marks is set aside and the next rule grows. A rule covers at
    least ``least`` growing bad rows. All counts cover all labelled rows.
    """
    bounds = _bounds(labelled, points)
    if not any(bounds.values()):
        return []
    rules: list[Rule] = []
    rest = labelled
    while len(rules) < most_rules:
        rule: Rule = ()
        growing = rest.where("growing")
        while len(rule) < most_conditions and (found := _best(growing, bounds, least)):
            rule += (found[0],)
            growing = growing.where(found[0].test())
            if not found[2]:
                break
        if not rule:
            break
        prefixes = [rule[: i + 1] for i in range(len(rule))]
        sums = [
            F.coalesce(F.sum(F.when(rule_test(p), value)), F.lit(0)).alias(f"{name}{i}")
            for i, p in enumerate(prefixes)
            for name, value in (("bad", F.col("bad")), ("good", 1 - F.col("bad")))
        ]
        seen = rest.where("not growing").agg(*sums).first()
        worth = [(seen[f"bad{i}"] - seen[f"good{i}"]) / max(1, seen[f"bad{i}"] + seen[f"good{i}"]) for i in range(len(rule))]
        cut = max(range(len(rule)), key=lambda i: (worth[i], -i))
        marked = seen[f"bad{cut}"] + seen[f"good{cut}"]
        if not marked or seen[f"bad{cut}"] < share * marked:
            break
        rules.append(prefixes[cut])
        rest = rest.where(~rule_test(prefixes[cut]))
    return rules


def keeps(rules: list[Rule]) -> Column:
    """The list as one conditional expression: false at the first rule that holds, else true."""
    if not rules:
        return F.lit(True)
    return reduce(lambda e, r: e.when(rule_test(r), False), rules[1:], F.when(rule_test(rules[0]), False)).otherwise(True)


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Counts, base verdict and learned verdict of every document.

    Labels with a null id or quality are left out; if an id repeats there, its lowest quality
    counts. Documents that repeat are each judged, and each counts in training. Without labels
    every document that passes the base rule is kept. A null text is empty and fails the base rule.
    """
    known = (
        labels.where("doc_id is not null and quality is not null")
        .groupBy("doc_id")
        .agg(F.min("quality").alias("_quality"))
    )
    rows = cut_lineage(text_counts(docs.select("doc_id", "text")))
    measured = rows.withColumns(measures())
    labelled = cut_lineage(
        measured.join(known, "doc_id").select(
            *MEASURES,
            (F.col("_quality") == 0).cast("int").alias("bad"),
            (F.crc32(F.concat(F.lit("grow"), F.col("doc_id").cast("string")).cast("binary")) % 3 != 0).alias("growing"),
        )
    )
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return measured.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & keeps(learn(labelled)))

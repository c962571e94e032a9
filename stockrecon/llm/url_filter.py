"""URL filters: listed rules, and character models of accepted and rejected URLs for the rest.

Host and path are written in 32 symbols (letters, one for all digits, ``/``, ``.``, ``-``, one
for everything else, one for the ends). Two Markov models, of URLs that a rule allows and of
URLs that a rule blocks, give each symbol a probability after the symbols before it: the
relative count after the longest context of up to three symbols that was seen often enough,
smoothed with the next shorter context, down to the uniform distribution. A URL's score is the
mean log ratio of the two models per symbol. One fifth of the ruled URLs takes no part in the
counts; the threshold is the score that parts its allowed from its blocked URLs best.

Counts of symbol windows are the only thing gathered: at most 32**4 of them however many URLs
there are, which bounds what is broadcast.

Defined results: null URLs and URLs without ``://`` have an empty host and path, fit no rule and
are scored as such; repeated rows each count and each get a row; page_id may be null; when no
URL is allowed or none is blocked by a rule, the method allows; extra columns do not matter.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stockrecon.llm.common import durable, let


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str

    def __str__(self) -> str:
        return self.host + self.path


#: Listed rules. Fixed values.
RULES = (
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
)

SYMBOLS = 32
_OTHER, _END = 30, 31
CONTEXT = 3
#: Weight of the shorter context, and the count from which a longer one is believed.
SMOOTHING, SEEN = 4.0, 2
#: One in this many ruled URLs is held out for the threshold.
HELD_OUT = 5
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Scores count in millionths of a nat, bins of the threshold in thousandths.
UNIT, BIN, WIDEST = 1_000_000, 1_000, 20_000


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"^(?s).*?://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"^(?s).*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """The longest rule that fits as a struct of ``rule`` and ``verdict``, or null."""
    found = []
    for rule in sorted(rules, key=lambda r: len(str(r)), reverse=True):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        found.append(F.when(fits, F.struct(F.lit(str(rule)).alias("rule"), F.lit(rule.verdict).alias("verdict"))))
    return F.coalesce(*found)


def _symbol(letter: Column) -> Column:
    table = [_OTHER] * 128
    for i in range(26):
        table[ord("a") + i] = table[ord("A") + i] = i
    for digit in range(10):
        table[ord("0") + digit] = 26
    table[ord("/")], table[ord(".")], table[ord("-")] = 27, 28, 29
    return F.coalesce(F.get(F.array(*map(F.lit, table)), F.ascii(letter)), F.lit(_OTHER))


def windows(text: Column) -> Column:
    """Per symbol, the end included, the number of the window of it and the three before it."""
    letters = F.filter(F.split(text, ""), lambda x: x != "")
    ends = F.array(*[F.lit(_END)] * CONTEXT)

    def number(padded: Column) -> Column:
        def at(i: Column) -> Column:
            total = F.get(padded, i)
            for k in range(1, CONTEXT + 1):
                total = total * SYMBOLS + F.get(padded, i + k)
            return total

        return F.transform(F.sequence(F.lit(0), F.size(padded) - CONTEXT - 1), at)

    return let(F.concat(ends, F.transform(letters, _symbol), F.array(F.lit(_END))), number)


def judged_rows(pages: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``page_id``, ``row``, ``host``, ``path``, ``rule``, ``listed``, ``held_out`` and ``windows``."""
    parts = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    ruled = parts.withColumn("found", rule_of(F.col("host"), F.col("path"), rules))
    return ruled.select(
        "page_id",
        F.monotonically_increasing_id().alias("row"),
        "host",
        "path",
        F.col("found.rule").alias("rule"),
        F.col("found.verdict").alias("listed"),
        (F.pmod(F.xxhash64("host", "path"), F.lit(HELD_OUT)) == 0).alias("held_out"),
        windows(F.concat("host", "path")).alias("windows"),
    )


def log_ratios(rows: DataFrame) -> DataFrame:
    """``window`` and ``ratio``: ln P(accepted) - ln P(rejected) in millionths, for every window that occurs."""
    learned = ~F.col("held_out")
    counts = durable(
        rows.select(
            (learned & (F.col("listed") == "allow")).alias("allow"),
            (learned & (F.col("listed") == "block")).alias("block"),
            F.explode("windows").alias("window"),
        )
        .groupBy("window")
        .agg(F.count_if("allow").alias("allow"), F.count_if("block").alias("block")),
        "windows",
    )
    shorter = None
    for length in range(1, CONTEXT + 2):
        level = counts.groupBy((F.col("window") % SYMBOLS**length).alias("window")).agg(
            F.sum("allow").alias("allow"), F.sum("block").alias("block")
        )
        context = Window.partitionBy(F.floor(F.col("window") / SYMBOLS))
        level = level.withColumns({f"{c}_all": F.sum(c).over(context) for c in ("allow", "block")})
        if shorter is None:
            uniform = F.lit(1.0 / SYMBOLS)
            level = level.withColumns({"allow_p": uniform, "block_p": uniform})
        else:
            level = level.withColumn("shorter", F.col("window") % SYMBOLS ** (length - 1)).join(shorter, "shorter")
        smooth = {
            f"{c}_p": F.when(F.col(f"{c}_all") < SEEN, F.col(f"{c}_p")).otherwise(
                (F.col(c) + SMOOTHING * F.col(f"{c}_p")) / (F.col(f"{c}_all") + SMOOTHING)
            )
            for c in ("allow", "block")
        }
        level = level.withColumns(smooth).select("window", "allow_p", "block_p")
        shorter = level.withColumnRenamed("window", "shorter")
    ratio = F.round(UNIT * (F.log("allow_p") - F.log("block_p"))).cast("long")
    return level.select("window", ratio.alias("ratio"))


def scores(rows: DataFrame, ratios: DataFrame) -> DataFrame:
    """One row per URL with ``score``, the mean log ratio in millionths.

    At most SYMBOLS**4 windows are broadcast. The symbols of a URL are summed before the
    shuffle, since they stand next to each other.
    """
    columns = ("row", "page_id", "host", "path", "rule", "listed", "held_out")
    spread = rows.select(*columns, F.explode("windows").alias("window"))
    summed = spread.join(F.broadcast(ratios), "window").groupBy(*columns)
    return summed.agg(F.floor(F.sum("ratio") / F.count("*")).cast("long").alias("score"))


def threshold(scored: DataFrame) -> int | None:
    """The score from which URLs are allowed; None if nothing was learned or held out.

    Among the bins of held-out scores, the least that makes the rates of allowed URLs kept and
    of blocked URLs refused add up to most; the limit lies midway to the bin below it.
    """
    binned = F.least(F.greatest(F.floor(F.col("score") / BIN), F.lit(-WIDEST)), F.lit(WIDEST)).cast("int")
    bins = (
        scored.where("held_out AND listed IS NOT NULL")
        .groupBy(binned.alias("bin"))
        .agg(F.count_if(F.col("listed") == "allow").alias("allow"), F.count_if(F.col("listed") == "block").alias("block"))
    )
    # At most 2 * WIDEST + 1 bins.
    below = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    gain = F.coalesce(F.sum("block").over(below), F.lit(0)) / F.sum("block").over(everything) - F.coalesce(
        F.sum("allow").over(below), F.lit(0)
    ) / F.sum("allow").over(everything)
    last = F.coalesce(F.lag("bin").over(Window.orderBy("bin")) + 1, F.col("bin"))
    measured = bins.select("bin", last.alias("last"), gain.alias("gain")).where("gain IS NOT NULL")
    best = measured.orderBy(F.desc("gain"), "bin").first()
    return None if best is None else (best["bin"] + best["last"]) * BIN // 2


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per page: ``page_id``, ``host``, ``path``, ``rule``, ``verdict`` and ``score`` in nats."""
    rows = durable(judged_rows(pages, rules), "url-rows")
    listed = {r["listed"] for r in rows.where("listed IS NOT NULL AND NOT held_out").select("listed").distinct().collect()}
    scored = durable(scores(rows, durable(log_ratios(rows), "log-ratios")), "url-scores")
    limit = threshold(scored) if listed == {"allow", "block"} else None
    method = F.lit("allow") if limit is None else F.when(F.col("score") >= limit, "allow").otherwise("block")
    return scored.select(
        "page_id", "host", "path", "rule", F.coalesce("listed", method).alias("verdict"), (F.col("score") / UNIT).alias("score")
    )

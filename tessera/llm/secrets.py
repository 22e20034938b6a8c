"""Secret scan with a randomness test battery, in DataFrame functions only.

Base kinds: assignments to a secret's name, access keys, long hex runs. The
method adds ``random``: runs of encoding characters, with digits or without. Of each
such run the narrowest encoding that holds all its characters gives an
alphabet; a chi-squared test of uniformity over it, a runs test about its
middle and a lag-1 serial correlation test ask if the run could be random
in it. The smallest of the three p-values, times three, is the run's. Runs with
less than ``min_random`` are patterns (counters, repeats) and no secrets.

These tests alone let words pass, as they have little power on runs of 16 to 20
letters. So a report is a rejection of another hypothesis: that the run is
made like the text's own words. The frequencies of adjacent letters in all shorter words of
the corpus (a table of 40 x 40, case folded) give a run's chance as text; divided
by its chance in its encoding, which is a p-value by Markov's inequality, times the number of
encodings. Over all runs of the corpus, a Benjamini-Hochberg procedure with
weights that grow with length picks the reported: long runs carry more evidence, so more of
the allowed error is theirs. ``level`` bounds the share of text among the reported, as far as
adjacent letters describe it. The procedure needs only a histogram of p-values of a fixed size.

A random letter brings about one bit of evidence, so runs under ``min_length`` are not
tested; those of fewer than ``min_bits`` bits, as of 16 digits, are not reported. A corpus without words has
nothing to tell runs from, and none is reported.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import stored, unused

#: Base kinds in order, with pattern and least length (of group 2 for assign).
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
KINDS = ("assign", "access", "hex", "random")
#: Runs of encoding characters of some length, tried from their first character only.
RUN = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{%d,}+"
#: Encodings, narrowest first: pattern and alphabet in ascending order of value.
DIGITS, LOWER = "0123456789", "abcdefghijklmnopqrstuvwxyz"
ENCODINGS = (
    ("^[0-9]+$", DIGITS),
    ("^[0-9a-f]+$", DIGITS + LOWER[:6]),
    ("^[0-9A-F]+$", DIGITS + LOWER[:6].upper()),
    ("^[A-Z2-7]+$", LOWER.upper() + "234567"),
    ("^[0-9a-z]+$", DIGITS + LOWER),
    ("^[0-9A-Z]+$", DIGITS + LOWER.upper()),
    ("^[0-9A-Za-z]+$", LOWER.upper() + LOWER + DIGITS),
    ("^[0-9A-Za-z_-]+$", LOWER.upper() + LOWER + DIGITS + "-_"),
    ("", LOWER.upper() + LOWER + DIGITS + "+/-_"),
)
#: Letters of the text's table, case folded, and the shares of its parts: adjacent letters, single letters, evenly.
FOLDED = LOWER + DIGITS + "+/-_"
SHARES = (0.8, 0.15, 0.05)
WORD = "[A-Za-z0-9+/_-]+"
#: Steps of the histogram to a power of ten, and its powers of ten.
STEPS, POWERS = 64, 40
SPAN = "array<struct<start:int,end:int>>"
#: Matches whose lengths add up at a time.
BLOCK = 256


def _spans(text: Column, pattern: str, accept: Column | None = None) -> Column:
    """(start, end) in code points of the leftmost non-overlapping matches;
    ``accept``: an array of booleans, one for each match.

    Lengths of gaps and matches add up in blocks: first over a block's sum, then
    within it, so a text of very many matches costs little more for each.
    """
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    lens = F.zip_with(hits, F.slice(gaps, F.lit(1), F.size(hits)), lambda h, g: F.struct(F.length(g).alias("gap"), F.length(h).alias("hit")))
    blocks = _bound(lens, lambda x: F.transform(F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(F.size(x) / BLOCK) - 1).cast("int")), lambda i: F.slice(x, i * BLOCK + 1, F.lit(BLOCK))))
    total = lambda block: F.aggregate(block, F.lit(0), lambda acc, x: acc + x["gap"] + x["hit"])
    ints = "array<int>"
    offsets = lambda bs: F.aggregate(
        bs, F.struct(F.lit(0).alias("at"), F.array().cast(ints).alias("out")),
        lambda acc, block: F.struct((acc["at"] + total(block)).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")), lambda acc: acc["out"],
    )
    within = lambda block, offset: F.aggregate(
        block,
        F.struct(offset.alias("at"), F.array().cast(SPAN).alias("out")),
        lambda acc, x: F.struct(
            (acc["at"] + x["gap"] + x["hit"]).alias("at"),
            F.concat(acc["out"], F.array(F.struct((acc["at"] + x["gap"]).alias("start"), (acc["at"] + x["gap"] + x["hit"]).alias("end")))).alias("out"),
        ),
        lambda acc: acc["out"],
    )
    placed = _bound(blocks, lambda bs: F.flatten(F.zip_with(bs, offsets(bs), within)))
    if accept is not None:
        both = F.filter(F.zip_with(placed, accept, lambda s, ok: F.struct(s["start"].alias("start"), s["end"].alias("end"), ok.alias("ok"))), lambda x: x["ok"])
        placed = F.transform(both, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end")))
    return F.when(text.rlike(pattern), placed).otherwise(F.array().cast(SPAN))


def _bound(value: Column, f) -> Column:
    """``f(value)`` with ``value`` computed once, however often f uses it."""
    return F.transform(F.array(value), f)[0]


def _tail(z: Column) -> Column:
    """P(|normal| > |z|): a rational approximation of erfc, error below 2e-7."""
    x = F.least(F.abs(z) / F.lit(2.0**0.5), F.lit(25.0))
    t = 1 / (1 + F.lit(0.3275911) * x)
    poly = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    return F.least(F.lit(1.0), F.greatest(poly * F.exp(-x * x), F.lit(1e-300)))


def _alphabet(run: Column) -> Column:
    out = F.lit(ENCODINGS[-1][1])
    for pattern, letters in reversed(ENCODINGS[:-1]):
        out = F.when(run.rlike(pattern), F.lit(letters)).otherwise(out)
    return out


def _battery(run: Column) -> Column:
    """struct(n, bits, p) of one run: length without padding, bits of its
    encoding, and the combined p-value of randomness."""
    def tested(x: Column) -> Column:
        size = F.length(x["letters"])
        n = F.size(x["v"])
        half = size / 2.0
        fold = F.aggregate(
            x["v"],
            F.struct(F.lit(0.0).alias("sum"), F.lit(0.0).alias("sq"), F.lit(0.0).alias("cross"), F.lit(0.0).alias("ups"), F.lit(0.0).alias("runs"), F.lit(-1.0).alias("last")),
            lambda a, v: F.struct(
                (a["sum"] + v).alias("sum"), (a["sq"] + v * v).alias("sq"),
                (a["cross"] + F.when(a["last"] >= 0, a["last"] * v).otherwise(0.0)).alias("cross"),
                (a["ups"] + (v >= half).cast("double")).alias("ups"),
                (a["runs"] + ((a["last"] < 0) | ((a["last"] >= half) != (v >= half))).cast("double")).alias("runs"), v.alias("last"),
            ),
        )
        bins = F.greatest(F.lit(2), F.least(size, F.floor(n / 5).cast("int")))
        return _bound(F.struct(fold.alias("f"), n.alias("n"), size.alias("size"), bins.alias("bins"), x["v"].alias("v")), measured)

    def measured(x: Column) -> Column:
        f, n, size, bins = x["f"], x["n"].cast("double"), x["size"].cast("double"), x["bins"]
        # letters of value v lie in bin floor(v * bins / size); a bin expects its share of letters
        edge = lambda b: F.ceil(b * size / bins)
        chi = F.aggregate(
            F.sequence(F.lit(0), bins - 1), F.lit(0.0),
            lambda acc, b: acc + F.pow(F.size(F.filter(x["v"], lambda v: F.floor(v * bins / size) == b)) - n * (edge(b + 1) - edge(b)) / size, F.lit(2.0)) / (n * (edge(b + 1) - edge(b)) / size),
        )
        df = (bins - 1).cast("double")
        z_chi = (F.pow(chi / df, F.lit(1 / 3)) - (1 - 2 / (9 * df))) / F.sqrt(2 / (9 * df))
        p_chi = F.when(z_chi > 0, _tail(z_chi) / 2).otherwise(1 - _tail(z_chi) / 2)
        ups, downs = f["ups"], n - f["ups"]
        mu = 2 * ups * downs / n + 1
        var = (mu - 1) * (mu - 2) / (n - 1)
        p_runs = F.when((ups == 0) | (downs == 0) | (var <= 0), F.lit(1e-300)).otherwise(_tail((f["runs"] - mu) / F.sqrt(F.greatest(var, F.lit(1e-9)))))
        first, last, mean = x["v"][0], f["last"], f["sum"] / n
        spread = f["sq"] - n * mean * mean
        shared = f["cross"] - mean * (2 * f["sum"] - first - last) + (n - 1) * mean * mean
        p_serial = F.when(spread <= 0, F.lit(1e-300)).otherwise(_tail((shared / F.greatest(spread, F.lit(1e-9)) + 1 / n) * F.sqrt(n)))
        p = F.least(F.lit(1.0), 3 * F.least(p_chi, p_runs, p_serial))
        return F.struct(x["n"].alias("n"), (n * F.log2(size)).alias("bits"), p.alias("p"))

    bare = F.regexp_replace(run, "[=]+", "")
    letters = lambda s: F.struct(s.alias("s"), _alphabet(s).alias("letters"))
    values = lambda y: F.struct(y["letters"].alias("letters"), F.transform(F.filter(F.split(y["s"], ""), lambda c: c != ""), lambda c: (F.instr(y["letters"], c) - 1).cast("double")).alias("v"))
    return _bound(bare, lambda s: _bound(letters(s), lambda y: _bound(values(y), tested)))


def text_table(docs: DataFrame, text: str = "text", min_length: int = 16) -> list[float]:
    """Bits of each letter after each other (row by row, in the order of FOLDED) in the
    words of all texts that are shorter than ``min_length``; a last row for first letters.

    Pairs are counted where the texts are read: at most 40 x 40 rows leave a task, and as many come to the driver.
    """
    words = docs.select(F.explode(F.regexp_extract_all(_text(text), F.lit(WORD), F.lit(0))).alias("w"))
    words = words.where((F.length("w") > 1) & (F.length("w") < min_length)).select(F.lower("w").alias("w"))
    pairs = words.select("w", F.explode(F.sequence(F.lit(1), F.length("w") - 1)).alias("i")).groupBy(F.substring("w", F.col("i"), F.lit(2)).alias("pair"))
    counts = {r["pair"]: r["k"] for r in pairs.agg(F.count("*").alias("k")).collect()}
    size = len(FOLDED)
    second = {b: sum(counts.get(a + b, 0) for a in FOLDED) for b in FOLDED}
    total = sum(second.values())
    single = {b: (second[b] + 1) / (total + size) for b in FOLDED}
    out = []
    for a in FOLDED:
        row = sum(counts.get(a + b, 0) for b in FOLDED)
        for b in FOLDED:
            after = (counts.get(a + b, 0) + size * single[b]) / (row + size)
            out.append(-math.log2(SHARES[0] * after + SHARES[1] * single[b] + SHARES[2] / size))
    return out + [-math.log2((1 - SHARES[2]) * single[b] + SHARES[2] / size) for b in FOLDED]


def _text_p(run: Column, table: list[float]) -> Column:
    """p-value of the run as text: its chance by ``table`` over its chance in its encoding."""
    bits = F.expr("array(" + ",".join(f"{x:.4f}D" for x in table) + ")")
    size = len(FOLDED)

    def tested(x: Column) -> Column:
        codes = F.transform(F.filter(F.split(F.lower(x["s"]), ""), lambda c: c != ""), lambda c: F.instr(F.lit(FOLDED), c) - 1)
        # both cases of a letter fold to one, which is then twice as likely in the encoding
        both = (F.instr(x["letters"], "a") > 0) & (F.instr(x["letters"], "A") > 0)
        even = F.log2(F.length(x["letters"]).cast("double"))
        sums = F.aggregate(
            codes, F.struct(F.lit(size).alias("last"), F.lit(0.0).alias("text"), F.lit(0.0).alias("even")),
            lambda a, c: F.struct(
                c.alias("last"), (a["text"] + F.get(bits, a["last"] * size + c)).alias("text"),
                (a["even"] + even - F.when(both & (c < len(LOWER)), 1.0).otherwise(0.0)).alias("even"),
            ),
        )
        return _bound(sums, lambda y: F.least(F.lit(1.0), F.greatest(F.lit(1e-300), len(ENCODINGS) * F.pow(F.lit(2.0), y["even"] - y["text"]))))

    bare = F.regexp_replace(run, "[=]+", "")
    return _bound(bare, lambda s: _bound(F.struct(s.alias("s"), _alphabet(s).alias("letters")), tested))


def candidates(text: Column, table: list[float], min_length: int = 16) -> Column:
    """array of (start, end, t: (n, bits, p), q) of the runs of ``min_length`` or more: p
    of randomness, q of text."""
    pattern = RUN % min_length
    runs = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    where = _spans(text, pattern)
    both = F.filter(F.zip_with(runs, where, lambda r, s: F.struct(r.alias("run"), s["start"].alias("start"), s["end"].alias("end"))), lambda x: F.length(F.regexp_replace(x["run"], "[=]+", "")) >= min_length)
    tested = F.transform(both, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), _battery(x["run"]).alias("t"), _text_p(x["run"], table).alias("q")))
    return F.when(text.rlike(pattern), tested).otherwise(F.array().cast("array<struct<start:int,end:int,t:struct<n:int,bits:double,p:double>,q:double>>"))


def _text(text: str) -> Column:
    return F.coalesce(F.col(text), F.lit(""))


def _evidence(run: Column, min_random: float) -> Column:
    """The p-value that a report has to reject: that of text, 1 for patterns."""
    return F.when(run["t"]["p"] < min_random, 1.0).otherwise(run["q"])


def rejection_step(scanned: DataFrame, runs: str = "runs", level: float = 0.05, min_random: float = 0.001) -> tuple[int, float]:
    """The histogram step from which on runs are reported, and the mean
    weight: the weighted Benjamini-Hochberg procedure over the candidates in ``runs`` of
    all rows. p-values count as the upper edge of their step.
    """
    rows = scanned.select(F.explode(runs).alias("c"))
    counts = stored(rows.groupBy("c.t.n", _step(_evidence(F.col("c"), min_random)).alias("step")).agg(F.count("*").alias("k")), "p-values")
    row = counts.agg(F.sum("k").alias("k"), F.sum(F.col("k") * F.sqrt("n")).alias("w")).first()
    if not row["k"]:
        return STEPS * POWERS + 1, 1.0
    mean = row["w"] / row["k"]
    # at most STEPS * POWERS + 1 rows
    steps = counts.groupBy(_weighted(F.col("step"), F.col("n"), mean).alias("step")).agg(F.sum("k").alias("k"))
    above = F.sum("k").over(Window.orderBy(F.desc("step")))
    ok = steps.withColumn("above", above).where(F.pow(F.lit(10.0), -F.col("step") / STEPS) * row["k"] <= level * F.col("above"))
    first = ok.agg(F.min("step")).first()[0]
    return (STEPS * POWERS + 1 if first is None else first), mean


def _step(p: Column) -> Column:
    """Histogram step of a p-value: p is in (10^-((step+1)/STEPS), 10^-(step/STEPS)]."""
    return F.greatest(F.lit(0), F.least(F.lit(STEPS * POWERS), F.floor(-F.log10(F.greatest(p, F.lit(1e-300))) * STEPS))).cast("int")


def _weighted(step: Column, n: Column, mean: float) -> Column:
    """The step of a p-value at the upper edge of ``step``, divided by the
    weight of a run of length n: sqrt(n), one in the mean."""
    return _step(F.pow(F.lit(10.0), -step / STEPS) * mean / F.sqrt(n))


def with_spans(
    docs: DataFrame, text: str = "text", out: str = "spans", level: float = 0.05, min_bits: float = 64.0, min_length: int = 16,
    min_random: float = 0.001, keep_text: bool = True,
) -> DataFrame:
    """``docs`` and a column ``out``: array of (start, kind, end), kinds numbered
    as in KINDS, in ascending order; code points, end exclusive.

    Null text reads as empty and has no spans. Whole texts are scanned, once for the words' letters and
    once for all spans; the rows and what was found in them are stored, without the texts
    unless ``keep_text``. Random runs that overlap a base span are left out. Repeated rows have the
    same spans each; an empty table gives no rows. Columns of ``docs`` stay as they are, but a
    column that is called ``out`` is replaced.
    """
    t = _text(text)
    long_enough = F.transform(F.regexp_extract_all(t, F.lit(ASSIGN), F.lit(2)), lambda g: F.length(g) >= 8)
    *columns, base = unused(docs, *KINDS, "base")
    names = dict(zip(KINDS, columns))
    rows = docs.withColumns({
        names["assign"]: _spans(t, ASSIGN, long_enough), names["access"]: _spans(t, ACCESS), names["hex"]: _spans(t, HEX),
        names["random"]: candidates(t, text_table(docs, text, min_length), min_length),
    })
    rows = stored(rows if keep_text else rows.drop(text), "scanned")
    step, mean = rejection_step(rows, names["random"], level, min_random)
    kind = lambda i: F.transform(names[KINDS[i]], lambda s: F.struct(s["start"].alias("start"), F.lit(i).alias("kind"), s["end"].alias("end")))
    rows = rows.withColumn(base, F.concat(kind(0), kind(1), kind(2)))
    random = F.filter(
        names["random"],
        lambda c: (c["t"]["bits"] >= min_bits) & (_weighted(_step(_evidence(c, min_random)), c["t"]["n"], mean) >= step)
        & ~F.exists(base, lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])),
    )
    added = F.transform(random, lambda s: F.struct(s["start"].alias("start"), F.lit(3).alias("kind"), s["end"].alias("end")))
    return rows.withColumn(out, F.array_sort(F.concat(base, added))).drop(base, *columns)


def joined(spans: Column) -> Column:
    """``kind:start:end`` of every span, comma-joined."""
    kinds = F.array(*map(F.lit, KINDS))
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))))


def redacted(docs: DataFrame, text: str = "text", mark: str = "[SECRET]", **options) -> DataFrame:
    """``docs`` with every span of ``text`` replaced by ``mark``, spans that
    overlap or touch by one. Null text stays null."""
    (spans,) = unused(docs, "spans")
    rows = with_spans(docs, text, spans, **options)
    t = F.col(text)
    cut = F.aggregate(
        spans,
        F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda a, s: F.struct(
            F.greatest(a["at"], s["end"]).alias("at"),
            # a span that starts within or right after the last one belongs to the same mark
            F.when((s["start"] <= a["at"]) & (a["at"] > 0), a["out"]).otherwise(F.concat(a["out"], F.substring(t, a["at"] + 1, s["start"] - a["at"]), F.lit(mark))).alias("out"),
        ),
        lambda a: F.concat(a["out"], F.substring(t, a["at"] + 1, F.length(t))),
    )
    return rows.withColumn(text, F.when(F.size(spans) > 0, cut).otherwise(t)).drop(spans)

"""Secret scan in DataFrame operations only.

Three fixed patterns give the base spans. Beyond them every run of 16 or more key characters that holds a
digit gets an inferred encoding (hex, base32, base36, base64) and a battery of randomness tests over that
alphabet: chi-squared uniformity, runs about the middle of the alphabet, and serial correlation at lag one.
Where no alphabet holds the whole run (a key of one case behind ``key_`` or between dashes), its parts between
``- _ + /`` are taken instead, those of 16 or more characters with a digit. What stays untested: shorter runs and
parts, those without any digit, and those of digits only.

* ``p_random``: three times the smallest of the three p-values under "drawn uniformly". Below
  ``REJECT_RANDOM`` the run is structured and cannot be a finding.
* ``p_ordinary``: how often ordinary text of that length looks this uniform. Its chi-squared value is
  non-central, and the shift grows with the length, so short runs have to be much more even than long ones.
* Runs of one encoding and one length band (powers of two) of the whole corpus form a family, in which the
  Benjamini-Hochberg rule bounds the share of false findings by ``FALSE_DISCOVERIES``. p-values are rounded
  up to hundredths of a decade, so a family is a table of at most ``GRADES`` counts.

Positions come from splitting a text at its matches and adding up lengths in code points.

Defined results: a null or empty text has no spans; repeated rows are reported each; a null key is carried;
columns named like an added one are replaced. Added spans may overlap base spans.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .frames import fresh, written

# The base patterns, and the least length of what counts.
ASSIGN = (
    r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
    r"|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ASSIGN_VALUE = 12
#: Runs shorter than the limit cannot match at any later place either, so the limit may be in the pattern.
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
KINDS = ("assign", "access", "hex", "random")

RUN = r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*+[0-9])[A-Za-z0-9+/_-]{16,}+={0,2}"
#: Parts of a run that has no encoding as a whole.
PART = r"(?<![A-Za-z0-9])(?=[A-Za-z]*+[0-9])[A-Za-z0-9]{16,}+={0,2}"
DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Encoding: pattern, alphabet in value order, chance that two symbols of ordinary text agree.
ENCODINGS = {
    "hex": (r"^(?=.*[a-fA-F])([0-9a-f]+|[0-9A-F]+)$", DIGITS + "abcdef", 0.10),
    "base32": (r"^(?=.*[A-Z])[A-Z2-7]+$", UPPER + "234567", 0.066),
    "base36": (r"^(?=.*[a-zA-Z])([a-z0-9]+|[A-Z0-9]+)$", DIGITS + LOWER, 0.066),
    "base64": (r"^(?=.*[a-z])(?=.*[A-Z])[A-Za-z0-9+/_-]+$", UPPER + LOWER + DIGITS + "+/", 0.066),
}
REJECT_RANDOM = 0.001
FALSE_DISCOVERIES = 0.05
GRADES = 3000


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, also where ``body`` uses it inside other lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def running(lengths: Column) -> Column:
    """Sum of the elements before each element. Blocks of 256 keep the copying linear."""
    def grow(acc, x):
        return F.concat(acc, F.array(F.element_at(acc, -1) + x))

    def over(blocks):
        totals = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0).cast("bigint"), lambda a, x: a + x))
        before = F.aggregate(totals, F.array(F.lit(0).cast("bigint")), grow)

        def inside(offsets):
            return F.flatten(
                F.transform(
                    blocks,
                    lambda b, i: F.slice(F.aggregate(b, F.array(F.element_at(offsets, i + 1)), grow), 1, F.size(b)),
                )
            )

        return let(before, inside)

    def blocks(values):
        count = F.ceil(F.size(values) / F.lit(256)).cast("int")
        return let(F.transform(F.sequence(F.lit(0), count - 1), lambda b: F.slice(values, b * 256 + 1, F.lit(256))), over)

    return let(
        lengths, lambda v: F.when(F.size(v) > 0, blocks(v)).otherwise(F.array().cast("array<bigint>"))
    )


def spans(text: Column, pattern: str, kind: str, group: int = 0, least: int = 0) -> Column:
    """Spans of all matches as (start, rank, end, kind, match) with the group's text if it is long enough."""
    rank = KINDS.index(kind)
    empty = F.array().cast("array<struct<start:bigint,rank:int,end:bigint,kind:string,match:string>>")

    def placed(found):
        lengths = F.zip_with(found["pieces"], found["matches"], lambda p, m: F.length(p) + F.length(m))
        cut = F.slice(lengths, 1, F.size(found["matches"]))  # the piece after the last match has none
        return let(
            running(F.transform(cut, lambda x: x.cast("bigint"))),
            lambda before: F.transform(
                found["matches"],
                lambda m, i: F.struct(
                    (F.element_at(before, i + 1) + F.length(F.element_at(found["pieces"], i + 1))).alias("start"),
                    F.lit(rank).alias("rank"),
                    (F.element_at(before, i + 1) + F.length(F.element_at(found["pieces"], i + 1)) + F.length(m)).alias("end"),
                    F.lit(kind).alias("kind"),
                    F.element_at(found["kept"], i + 1).alias("match"),
                ),
            ),
        )

    found = F.struct(
        F.split(text, pattern, -1).alias("pieces"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("matches"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("kept"),
    )
    out = let(found, placed)
    if least:
        out = F.filter(out, lambda s: F.length(s["match"]) >= least)
    return F.when(text.rlike(pattern), out).otherwise(empty)


def _normal_tail(z: Column) -> Column:
    """P(Z > z): a published rational approximation of the error function, seven digits."""
    x = F.abs(z) / F.lit(2.0**0.5)
    t = 1 / (1 + 0.3275911 * x)
    poly = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    upper = 0.5 * poly * F.exp(-x * x)
    return F.when(z >= 0, upper).otherwise(1 - upper)


def _square_sum(symbols: Column, alphabet: Column) -> Column:
    """Sum of squared counts over the alphabet."""
    return F.aggregate(
        F.split(alphabet, ""),
        F.lit(0.0),
        lambda acc, c: acc + F.pow(F.length(symbols) - F.length(F.replace(symbols, c, F.lit(""))), F.lit(2.0)),
    )


def halves(alphabet: str) -> str:
    """0 for the lower half of an alphabet, 1 for the upper."""
    return "".join("0" if i < len(alphabet) // 2 else "1" for i in range(len(alphabet)))


def battery(symbols: Column, alphabet: Column, half: Column, agreement: Column) -> Column:
    """(p_random, p_ordinary) of a string over ``alphabet``; ``half`` is as ``halves`` gives it."""

    def tests(s):
        n, size = F.length(s).cast("double"), F.length(alphabet).cast("double")
        chi = size / n * _square_sum(s, alphabet) - n
        k = size - 1
        uneven = _normal_tail((F.pow(chi / k, F.lit(1 / 3)) - (1 - 2 / (9 * k))) / F.sqrt(2 / (9 * k)))
        shift = n * (size * agreement - 1)
        ordinary = 1 - _normal_tail((chi - k - shift) / F.sqrt(2 * k + 4 * shift))

        def runs(bits):
            ones = F.length(F.replace(bits, F.lit("0"), F.lit(""))).cast("double")
            zeros = n - ones
            changes = sum(
                (F.length(bits) - F.length(F.replace(bits, F.lit(x), F.lit("0"))) for x in ("01", "10")), F.lit(0)
            )
            mean = 2 * ones * zeros / n + 1
            spread = F.sqrt((mean - 1) * (mean - 2) / (n - 1))
            return F.when((ones == 0) | (zeros == 0) | (spread <= 0), F.lit(0.0)).otherwise(
                2 * _normal_tail(F.abs((changes + 1 - mean) / spread))
            )

        def serial(values):
            mean = F.aggregate(values, F.lit(0.0), lambda a, v: a + v) / n

            def at(m):
                spread = F.aggregate(values, F.lit(0.0), lambda a, v: a + (v - m) * (v - m))
                pairs = F.zip_with(values, F.slice(values, 2, F.size(values)), lambda a, b: (a - m) * (b - m))
                together = F.aggregate(F.slice(pairs, 1, F.size(values) - 1), F.lit(0.0), lambda a, v: a + v)
                return let(
                    spread,
                    lambda v: F.when(v > 0, 2 * _normal_tail(F.abs((together / v + 1 / n) * F.sqrt(n)))).otherwise(F.lit(0.0)),
                )

            return let(mean, at)

        values = F.transform(F.split(s, ""), lambda c: (F.instr(alphabet, c) - 1).cast("double"))
        smallest = F.least(uneven, let(F.call_function("translate", s, alphabet, half), runs), let(values, serial))
        return F.struct(F.least(3 * smallest, F.lit(1.0)).alias("p_random"), ordinary.alias("p_ordinary"))

    return let(symbols, tests)


def _encoding(core: Column) -> Column:
    """The first encoding whose pattern fits, with what the tests need; null if none does."""
    found = F.lit(None).cast("struct<name:string,alphabet:string,half:string,agreement:double>")
    for name, (pattern, alphabet, agreement) in reversed(ENCODINGS.items()):
        known = F.struct(
            F.lit(name).alias("name"), F.lit(alphabet).alias("alphabet"), F.lit(halves(alphabet)).alias("half"), F.lit(agreement).alias("agreement")
        )
        found = F.when(core.rlike(pattern), known).otherwise(found)
    return found


def _plain(core: Column, name: Column) -> Column:
    """Symbols spelled in the encoding's alphabet."""
    return (
        F.when(name.isin("hex", "base36"), F.lower(core)).when(name == "base64", F.translate(core, "-_", "+/")).otherwise(core)
    )


def candidates(text: Column) -> Column:
    """Runs of key characters with encoding, length band and grade of their p-value, as an array."""

    def judged(span):
        def known(core, e):
            return let(
                battery(_plain(core, e["name"]), e["alphabet"], e["half"], e["agreement"]),
                lambda t: F.struct(
                    span["start"].alias("start"),
                    span["end"].alias("end"),
                    e["name"].alias("encoding"),
                    F.floor(F.log2(F.length(core).cast("double"))).cast("int").alias("band"),
                    # Structured runs count in their family but are never findings.
                    F.when(t["p_random"] < REJECT_RANDOM, 0)
                    .otherwise(F.least(F.floor(-100 * F.log10(F.greatest(t["p_ordinary"], F.lit(1e-30)))), F.lit(GRADES)))
                    .cast("int")
                    .alias("grade"),
                ),
            )

        core = F.regexp_replace(span["match"], "=+$", "")
        return let(core, lambda c: let(_encoding(c), lambda e: F.when(e.isNotNull(), known(c, e))))

    def parts(run):
        """Judged parts of a run, placed in the text."""
        inside = spans(run["match"], PART, "random")
        at = F.transform(
            inside,
            lambda p: F.struct((run["start"] + p["start"]).alias("start"), (run["start"] + p["end"]).alias("end"), p["match"].alias("match")),
        )
        return F.transform(at, judged)

    def split(runs):
        whole = F.transform(runs, lambda r: r["found"])
        unfit = F.filter(runs, lambda r: r["found"].isNull())
        return F.filter(F.concat(whole, F.flatten(F.transform(unfit, lambda r: parts(r["run"])))), lambda c: c.isNotNull())

    runs = F.transform(spans(text, RUN, "random"), lambda r: F.struct(r.alias("run"), judged(r).alias("found")))
    return let(runs, split)


def thresholds(found: DataFrame, rate: float = FALSE_DISCOVERIES) -> DataFrame:
    """Per family the least grade that the Benjamini-Hochberg rule accepts (families without one are absent)."""
    counts = (
        found.select(F.explode("found.candidates").alias("c"))
        .groupBy("c.encoding", "c.band", "c.grade")
        .agg(F.count("*").alias("n"))
    )
    family = Window.partitionBy("encoding", "band")
    best_first = family.orderBy(F.desc("grade"))
    ranked = counts.withColumn("k", F.sum("n").over(best_first)).withColumn("m", F.sum("n").over(family))
    good = (F.col("grade") > 0) & (F.pow(F.lit(10.0), -F.col("grade") / 100) <= rate * F.col("k") / F.col("m"))
    return ranked.where(good).groupBy("encoding", "band").agg(F.min("grade").alias("least"))


def found_in(text: Column) -> Column:
    """Base spans and candidates of a text."""
    base = F.concat(
        spans(text, ASSIGN, "assign", 2, ASSIGN_VALUE),
        spans(text, ACCESS, "access"),
        spans(text, HEX, "hex"),
    )
    slim = F.transform(base, lambda s: F.struct(s["start"], s["rank"], s["end"], s["kind"]))
    return F.struct(slim.alias("base"), candidates(text).alias("candidates"))


def accepted(found: DataFrame, rate: float) -> Callable[[Column], Column]:
    """The added spans of a ``found`` value. The rule holds one number for each encoding and power of two."""
    least = {(r.encoding, r.band): r.least for r in thresholds(found, rate).collect()}

    def good(c):
        hit = F.lit(False)
        for (encoding, band), grade in sorted(least.items()):
            hit = hit | ((c["encoding"] == encoding) & (c["band"] == band) & (c["grade"] >= grade))
        return hit

    rank = F.lit(KINDS.index("random"))
    return lambda value: F.transform(
        F.filter(value["candidates"], good),
        lambda c: F.struct(c["start"].alias("start"), rank.alias("rank"), c["end"].alias("end"), F.lit("random").alias("kind")),
    )


ADDED = ("n_assign", "n_access", "n_hex", "n_random", "base_sha256", "spans")


def _whole(text: str) -> Column:
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def scan(docs: DataFrame, text: str = "text", keep: list[str] | None = None, rate: float = FALSE_DISCOVERIES) -> DataFrame:
    """``docs`` (or its columns ``keep``) with counts and spans; each text is read once."""
    carried = [c for c in (docs.columns if keep is None else keep) if c.lower() not in (*ADDED, "found")]
    found = written(docs.select(*carried, found_in(_whole(text)).alias("found")), "secrets")
    added = accepted(found, rate)(F.col("found"))

    def listed(array):
        return F.array_join(
            F.transform(
                F.array_sort(array),
                lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
            ),
            ",",
        )

    def count(kind):
        return F.size(F.filter("found.base", lambda s: s["kind"] == kind)).cast("bigint")

    return found.select(
        *carried,
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.size(added).cast("bigint").alias("n_random"),
        F.sha2(listed(F.col("found.base")), 256).alias("base_sha256"),
        listed(F.concat(F.col("found.base"), added)).alias("spans"),
    )


MASK = "<secret>"


def redacted(docs: DataFrame, text: str = "text", length: str | None = "n_chars", rate: float = FALSE_DISCOVERIES) -> DataFrame:
    """``docs`` with every span, overlapping ones together, replaced by ``MASK``; ``length`` follows the text.

    The columns and rows stay as they are, and texts without a span are not touched, nulls included. The
    texts are scanned twice, once for the corpus-wide rule, so that no text is written in between.
    """
    rule = accepted(docs.select(found_in(_whole(text)).alias("found")), rate)

    def masked(value):
        ordered = F.array_sort(F.transform(F.concat(value["base"], rule(value)), lambda s: F.struct(s["start"], s["end"])))
        start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<string>").alias("parts"))

        def step(acc, s):
            whole = F.col(text)
            piece = F.when(s["start"] >= acc["at"], F.concat(F.substring(whole, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int")), F.lit(MASK)))
            parts = F.when(piece.isNull(), acc["parts"]).otherwise(F.concat(acc["parts"], F.array(piece)))
            return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), parts.alias("parts"))

        def finish(acc):
            rest = F.substring(F.col(text), (acc["at"] + 1).cast("int"), F.length(text))
            return F.concat(F.array_join(acc["parts"], ""), rest)

        return let(ordered, lambda o: F.when(F.size(o) > 0, F.aggregate(o, start, step, finish)).otherwise(F.col(text)))

    new = fresh(docs, "_masked")
    out = docs.withColumn(new, let(found_in(_whole(text)), masked))
    changed = {text: F.col(new)}
    if length and length in docs.columns:
        kind = docs.schema[length].dataType
        changed[length] = F.when(F.col(new).eqNullSafe(F.col(text)), F.col(length)).otherwise(F.length(new).cast(kind))
    return out.select(*[changed[c].alias(c) if c in changed else F.col(f"`{c}`") for c in docs.columns])

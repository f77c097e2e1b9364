"""Secret scans: format rules, and a battery of randomness tests on opaque tokens.

All of it is column expressions on the row's own text; nothing is shuffled.

A candidate is a long run of base-64 or URL-safe characters.  Its encoding is
inferred from the characters it uses.  Under the hypothesis that it is random
in that encoding, four statistics are computed: chi-squared over the characters
of the alphabet and over its classes (digits, halves of the letters, marks),
runs above and below the middle, and serial correlation of neighbours.
Fisher's method combines them.  Within a document, a step-up procedure dismisses candidates as text
while it controls the share of dismissed secrets; a candidate's weight grows
with its length, because long ones give the tests more power.  What is not
dismissed and carries enough bits is reported as `random`.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.spans import between, highest_before, let, match_spans, pieces

# The patterns of the three base kinds, in the order in which they are listed.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
ASSIGN_LEAST = 12
KINDS = ("assign", "access", "hex", "random")

#: Opaque tokens.
TOKEN = r"[A-Za-z0-9+/_-]{20,}={0,2}"
LEAST_BITS = 80.0
#: Rate of false discoveries: of random tokens among those dismissed as text.
RATE = 0.01

# name, characters, size of the alphabet, and the classes that its characters fall into with their sizes
ENCODINGS = (
    ("decimal", r"^[0-9]+$", 10, (("0123", 4), ("4567", 4), ("89", 2))),
    ("hex", r"^[0-9a-f]+$", 16, (("0123", 4), ("4567", 4), ("89ab", 4), ("cdef", 4))),
    ("HEX", r"^[0-9A-F]+$", 16, (("0123", 4), ("4567", 4), ("89AB", 4), ("CDEF", 4))),
    ("base32", r"^[A-Z2-7]+=*$", 32, (("ABCDEFGHI", 9), ("JKLMNOPQ", 8), ("RSTUVWXYZ", 9), ("234567", 6))),
    ("base36", r"^[0-9a-z]+$", 36, (("abcdefghi", 9), ("jklmnopq", 8), ("rstuvwxyz", 9), ("0123456789", 10))),
    ("base64", r"^.*$", 64, (("abcdefghijklm", 13), ("nopqrstuvwxyz", 13), ("ABCDEFGHIJKLM", 13), ("NOPQRSTUVWXYZ", 13), ("0123456789", 10), ("+/-_", 2))),
)
_ORDER = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz+/-_"


def _upper_tail(z: Column) -> Column:
    """1 - Phi(z) for z >= 0, by the rational approximation of Abramowitz and Stegun 26.2.17."""

    def tail(t: Column) -> Column:
        poly = 1.330274429
        for c in (-1.821255978, 1.781477937, -0.356563782, 0.319381530):
            poly = c + t["t"] * poly
        return F.greatest(F.exp(-t["z"] * t["z"] / 2) / 2.5066282746310002 * t["t"] * poly, F.lit(1e-300))

    return let(z, lambda z: let(F.struct(z.alias("z"), (1 / (1 + 0.2316419 * z)).alias("t")), tail))


def _two_sided(z: Column) -> Column:
    return F.least(2 * _upper_tail(F.abs(z)), F.lit(1.0))


def _chi_squared_tail(x: Column, k: Column) -> Column:
    """Upper tail by the cube-root normal approximation of Wilson and Hilferty."""
    z = (F.cbrt(x / k) - (1 - 2 / (9 * k))) / F.sqrt(2 / (9 * k))
    return let(z, lambda z: let(_upper_tail(F.abs(z)), lambda u: F.when(z >= 0, u).otherwise(1 - u)))


def _count_of(token: Column, characters: str) -> Column:
    """How many characters of the token are among `characters` (code units of ASCII)."""
    return (F.length(token) - F.length(F.translate(token, characters, ""))).cast("double")


def _battery(token: Column) -> Column:
    """struct(p, bits): how well the token agrees with randomness in its encoding, and its size."""

    def uniformity(body: Column) -> Column:
        """Chi-squared over characters and over classes, degrees of freedom of both, and bits in the first encoding that fits."""
        n = F.length(body).cast("double")
        seen = F.array_distinct(F.split(body, "(?!$)"))
        squares = F.aggregate(seen, F.lit(0.0), lambda a, c: a + F.pow(n - F.length(F.replace(body, c, F.lit(""))), 2))
        out = None
        for _, shape, size, classes in reversed(ENCODINGS):
            chi = sum(F.pow(_count_of(body, c) - n * (share / size), 2) / (n * (share / size)) for c, share in classes)
            this = F.struct(F.lit(float(size)).alias("size"), chi.alias("chi"), F.lit(float(len(classes) - 1)).alias("df"), (n * math.log2(size)).alias("bits"))
            out = this if out is None else F.when(body.rlike(shape), this).otherwise(out)

        def with_characters(c: Column) -> Column:
            return F.struct((squares * c["size"] / n - n).alias("each"), (c["size"] - 1).alias("each_df"), c["chi"].alias("chi"), c["df"].alias("df"), c["bits"].alias("bits"))

        return let(out, with_characters)

    def centred(codes: Column) -> Column:
        return let(F.aggregate(codes, F.lit(0.0), lambda a, x: a + x) / F.size(codes), lambda mean: F.transform(codes, lambda x: x - mean))

    def sums(x: Column) -> Column:
        total = lambda values: F.aggregate(values, F.lit(0.0), lambda a, v: a + v)
        one, two = F.slice(x, F.lit(1), F.size(x) - 1), F.slice(x, F.lit(2), F.size(x) - 1)
        flag = lambda c: F.when(c, F.lit(1.0)).otherwise(F.lit(0.0))
        return F.struct(
            F.size(x).cast("double").alias("n"),
            total(F.zip_with(one, two, lambda a, b: a * b)).alias("lag"),
            total(F.transform(x, lambda v: v * v)).alias("var"),
            (1 + total(F.zip_with(one, two, lambda a, b: flag((a > 0) != (b > 0))))).alias("runs"),
            total(F.transform(x, lambda v: flag(v > 0))).alias("high"),
        )

    def order_tests(m: Column) -> Column:
        """Product of the p-values of the runs test and of serial correlation, as minus its logarithm."""
        mean = 1 + 2 * m["high"] * (m["n"] - m["high"]) / m["n"]
        runs = let(mean, lambda e: _two_sided((m["runs"] - e) / F.sqrt(F.greatest((e - 1) * (e - 2) / (m["n"] - 1), F.lit(1e-9)))))
        runs = F.when((m["high"] == 0) | (m["high"] == m["n"]), F.lit(1e-12)).otherwise(runs)
        serial = F.when(m["var"] <= 0, F.lit(1e-12)).otherwise(_two_sided((m["lag"] / m["var"] + 1 / m["n"]) * F.sqrt(m["n"])))
        return -(F.ln(runs) + F.ln(serial))

    def combined(body: Column) -> Column:
        codes = F.transform(F.filter(F.split(body, ""), lambda c: c != ""), lambda c: F.instr(F.lit(_ORDER), c).cast("double"))
        order = let(let(centred(codes), sums), order_tests)

        def joined(c: Column) -> Column:
            tails = (F.ln(F.greatest(_chi_squared_tail(c[chi], c[df]), F.lit(1e-300))) for chi, df in (("each", "each_df"), ("chi", "df")))
            half = order - sum(tails)
            # tail of chi-squared with eight degrees of freedom at 2 h
            return let(half, lambda h: F.struct((F.exp(-h) * (1 + h + h * h / 2 + h * h * h / 6)).alias("p"), c["bits"].alias("bits")))

        return let(uniformity(body), joined)

    return let(F.rtrim(F.translate(token, "=", " ")), combined)


def _random_spans(text: Column) -> Column:
    """Opaque tokens that the step-up procedure doesn't dismiss."""
    tested = F.transform(match_spans(text, TOKEN), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), _battery(s["hit"]).alias("b")))

    def weighted(tested: Column) -> Column:
        m = F.greatest(F.size(tested), F.lit(1))
        mean = F.aggregate(tested, F.lit(0.0), lambda a, s: a + s["end"] - s["start"]) / m
        return let(mean, lambda mean: F.transform(tested, lambda s: F.struct((s["b"]["p"] * mean / (s["end"] - s["start"])).alias("q"), s["start"].alias("start"), s["end"].alias("end"), s["b"]["bits"].alias("bits"))))

    def chosen(weighed: Column) -> Column:
        m = F.greatest(F.size(weighed), F.lit(1))
        ordered = F.transform(F.array_sort(weighed), lambda s, i: F.struct(s["q"].alias("q"), (i + 1).alias("rank")))
        # the largest value that the step-up procedure rejects; below all values if it rejects none
        limit = F.aggregate(ordered, F.lit(-1.0), lambda a, s: F.when(s["q"] <= RATE * s["rank"] / m, F.greatest(a, s["q"])).otherwise(a))
        return let(limit, lambda limit: F.filter(weighed, lambda s: (s["q"] > limit) & (s["bits"] >= LEAST_BITS)))

    return let(let(tested, weighted), chosen)


def spans_of(text: Column) -> Column:
    """All spans of a text that is not null: (start, rank of the kind, end), in order."""
    none = F.from_json(F.lit("[]"), "array<struct<start:int,rank:int,end:int>>")

    def ranked(spans: Column, rank: int) -> Column:
        return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end")))

    assign = F.filter(match_spans(text, ASSIGN), lambda s: F.length(F.regexp_extract(s["hit"], ASSIGN, 2)) >= ASSIGN_LEAST)
    parts = (
        F.when(text.rlike(r"(?i)passw|secret|token|api_?key"), ranked(assign, 0)).otherwise(none),
        F.when(F.contains(text, F.lit("AKIA")), ranked(match_spans(text, ACCESS), 1)).otherwise(none),
        F.when(text.rlike(HEX), ranked(match_spans(text, HEX), 2)).otherwise(none),
        F.when(text.rlike(r"[A-Za-z0-9+/_-]{20}"), ranked(_random_spans(text), 3)).otherwise(none),
    )
    return F.array_sort(F.concat(*parts))


def scan(docs: DataFrame) -> DataFrame:
    """`docs` with `found`: all spans (start, rank of the kind, end) in order, and the counts of the base kinds.

    Looks at the column `text`; a null one is empty.  Every row is kept, also
    repeated ones; columns named `found`, `n_assign`, `n_access` and `n_hex`
    are replaced, all others pass through.
    """
    out = docs.withColumn("found", spans_of(F.coalesce(F.col("text"), F.lit(""))))
    def count(rank: int) -> Column:
        return F.size(F.filter("found", lambda s: s["rank"] == rank)).cast("long")

    return out.withColumns({"n_assign": count(0), "n_access": count(1), "n_hex": count(2)})


def rendered(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(kinds, s["rank"] + 1), s["start"], s["end"])), ",")


def redacted(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """`docs` with every secret in `text` replaced by `mark`, and n_chars set anew; rows without one stay as they are.

    A null or empty text stays as it is, overlapping spans give one mark, repeated
    rows are each rewritten, an empty table stays empty, and other columns pass.
    """
    names = docs.columns
    out = docs.withColumn("tidemark_spans", spans_of(F.coalesce(F.col("text"), F.lit(""))))
    changed = F.size("tidemark_spans") > 0

    def rewritten(row: Column) -> Column:
        """What lies before each span that begins beyond all ends before it, a mark after each, and the rest; row: (spans, reached, parts)."""

        def piece(s: Column, i: Column) -> Column:
            before = F.element_at(row["reached"], i + 1)
            # a span that overlaps what is already replaced only extends it
            return F.when(s["start"] >= before, F.concat(between(row["parts"], before, s["start"]), F.lit(mark))).otherwise("")

        last = F.array_max(F.transform(row["spans"], lambda s: s["end"]))
        return F.concat(F.array_join(F.transform(row["spans"], piece), ""), between(row["parts"], last, F.length("text")))

    spans = F.col("tidemark_spans")
    row = F.struct(spans.alias("spans"), highest_before(F.transform(spans, lambda s: s["end"])).alias("reached"), pieces(F.col("text")).alias("parts"))
    out = out.withColumn("tidemark_text", F.when(changed, let(row, rewritten)).otherwise(F.col("text")))
    columns = {"text": F.col("tidemark_text")}
    if "n_chars" in names:
        columns["n_chars"] = F.when(changed, F.length("tidemark_text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return out.withColumns(columns).select(names)

"""Secret scan: fixed patterns, and a battery of randomness tests on other long tokens.

Native: DataFrame functions only, no shuffle of texts. A text is split by a pattern and
the same matches are extracted; running sums of their lengths give every match's place
in code points.

The battery asks of each run of 20 or more token characters whether its characters look
drawn at random from the alphabet of the encoding they suggest (digits, hexadecimal,
base 32, base 64): chi-squared test of uniform counts, runs above and below the middle of
the alphabet, and correlation of neighbours, combined by Fisher's method to one p-value,
which is uniform for random tokens and near 0 for ordinary ones. Tokens of one encoding
and length class form a stratum. How many of them are random follows from the tokens
above p = 0.5; a token is reported if its p-value is above the least cut at which at most
FALSE_SHARE of all reported ones is expected to be ordinary. Short classes, where the
tests say little, thus need higher p-values.

Null and empty texts have no spans; repeated rows are scanned each for itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wakeline.sources.staging import staged

# Fixed patterns of the contract, and the least length of what must be that long.
KINDS = ("assign", "access", "hex", "random")
PATTERNS = {
    "assign": r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]+",
    "hex": r"[0-9a-f]{24,}",
    "random": r"[A-Za-z0-9+/_-]{20,}={0,2}",
}
ASSIGN_VALUE, ACCESS_CHARS = 6, 20
FALSE_SHARE = 0.1
BINS = 100
_RUN = 512

# Alphabets in the order of their digits.
ALPHABETS = {
    "decimal": "0123456789",
    "hex": "0123456789abcdef",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
}


def _running(values: Column) -> Column:
    """Running sums of an array, in pieces so that work grows in proportion."""

    def fold(part: Column, first: Column) -> Column:
        return F.aggregate(
            part,
            F.array(first),
            lambda sums, x: F.array_append(sums, F.element_at(sums, -1) + x),
        )

    zero = F.lit(0).cast("long")
    piece = lambda k: F.slice(values, k * _RUN + 1, F.lit(_RUN))
    pieces = F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((F.size(values) - 1) / _RUN).cast("int")))
    totals = F.transform(pieces, lambda k: F.aggregate(piece(k), zero, lambda a, x: a + x))
    carries = fold(totals, zero)
    return F.flatten(
        F.transform(
            F.arrays_zip(pieces.alias("k"), F.slice(carries, F.lit(1), F.size(pieces)).alias("c")),
            lambda z: F.slice(fold(piece(z["k"]), z["c"]), F.lit(2), F.lit(_RUN)),
        )
    )


def _with_matches(df: DataFrame, kind: str, text: str = "_text") -> DataFrame:
    """Add the matches of a kind as an array of (start, kind, end, match)."""
    pattern = PATTERNS[kind]
    hit = F.col(text).rlike(pattern)
    none = F.array().cast("array<string>")
    df = df.withColumn("_hit", hit)
    df = df.withColumn(
        "_found",
        F.when(F.col("_hit"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(none),
    ).withColumn("_parts", F.when(F.col("_hit"), F.split(text, pattern, -1)).otherwise(none))
    steps = F.zip_with(
        "_found",
        F.slice("_parts", F.lit(1), F.size("_found")),
        lambda match, part: (F.length(match) + F.length(part)).cast("long"),
    )
    df = df.withColumn("_steps", steps).withColumn("_ends", _running(F.col("_steps")))
    place = KINDS.index(kind)
    spans = F.zip_with(
        "_found",
        "_ends",
        lambda match, end: F.struct(
            (end - F.length(match)).alias("start"),
            F.lit(place).alias("kind"),
            end.alias("end"),
            match.alias("match"),
        ),
    )
    return df.withColumn(f"_{kind}", spans).drop("_hit", "_found", "_parts", "_steps", "_ends")


def _tail(z: Column) -> Column:
    """Upper tail of the normal distribution (logistic form, error below 0.0002)."""
    cubic = z * (1.5957691216 + 0.0705657 * z * z)
    return 1.0 / (1.0 + F.exp(F.least(cubic, F.lit(700.0))))


def _battery(tokens: DataFrame) -> DataFrame:
    """Add encoding, stratum and the p-value of randomness to rows with a ``match``."""
    core = F.regexp_replace("match", "=+$", "")
    encoding = (
        F.when(F.col("_core").rlike("^[0-9]+$"), "decimal")
        .when(F.col("_core").rlike("^([0-9a-f]+|[0-9A-F]+)$"), "hex")
        .when(F.col("_core").rlike("^[A-Z2-7]+$"), "base32")
        .otherwise("base64")
    )
    folded = (
        F.when(F.col("encoding") == "hex", F.lower("_core"))
        .when(F.col("encoding") == "base64", F.translate("_core", "-_", "+/"))
        .otherwise(F.col("_core"))
    )
    table = F.lit("")
    size = F.lit(0)
    for name, letters in ALPHABETS.items():
        table = F.when(F.col("encoding") == name, F.lit(letters)).otherwise(table)
        size = F.when(F.col("encoding") == name, F.lit(len(letters))).otherwise(size)
    digits = F.transform(
        F.split("_folded", ""), lambda c: (F.instr(F.col("_letters"), c) - 1).cast("double")
    )
    rows = (
        tokens.withColumn("_core", core)
        .withColumn("encoding", encoding)
        .withColumn("_folded", folded)
        .withColumn("_letters", table)
        .withColumn("_a", size.cast("double"))
        .withColumn("_x", F.filter(digits, lambda d: d >= 0))
        .withColumn("_n", F.size("_x").cast("double"))
    )
    counts = F.transform(
        F.split("_letters", ""),
        lambda c: (F.length("_folded") - F.length(F.replace(F.col("_folded"), c, F.lit("")))).cast("double"),
    )
    squares = F.aggregate(
        F.when(F.length("_letters") > 0, counts), F.lit(0.0), lambda s, c: s + c * c
    )
    middle = (F.col("_a") - 1) / 2
    spread = (F.col("_a") * F.col("_a") - 1) / 12
    ahead = F.slice("_x", F.lit(2), F.size("_x"))
    pairs = F.zip_with(F.slice("_x", F.lit(1), F.size("_x") - 1), ahead, lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    changes = F.size(F.filter(pairs, lambda p: (p["a"] > middle) != (p["b"] > middle)))
    products = F.aggregate(pairs, F.lit(0.0), lambda s, p: s + (p["a"] - middle) * (p["b"] - middle))
    steps = F.col("_n") - 1
    free = F.col("_a") - 1
    chi = squares * F.col("_a") / F.col("_n") - F.col("_n")
    # Wilson and Hilferty's cube root makes chi-squared normal.
    chi_z = (F.cbrt(F.greatest(chi, F.lit(0.0)) / free) - (1 - 2 / (9 * free))) / F.sqrt(2 / (9 * free))
    runs_z = (changes - steps / 2) / F.sqrt(steps / 4)
    serial_z = products / (spread * F.sqrt(steps))
    least = 1e-300
    p_chi = F.greatest(_tail(F.col("_chi")), F.lit(least))
    p_runs = F.greatest(2 * _tail(F.abs("_runs")), F.lit(least))
    p_serial = F.greatest(2 * _tail(F.abs("_serial")), F.lit(least))
    x = F.col("_half")
    return (
        rows.withColumn("_chi", chi_z)
        .withColumn("_runs", runs_z)
        .withColumn("_serial", serial_z)
        .withColumn("_half", -(F.log(p_chi) + F.log(p_runs) + F.log(p_serial)))
        .withColumn("p", F.least(F.lit(1.0), F.exp(-x) * (1 + x + x * x / 2)))
        .withColumn("stratum", F.concat_ws(":", "encoding", F.floor(F.log2("_n")).cast("string")))
    )


def cuts(scored: DataFrame, false_share: float = FALSE_SHARE) -> DataFrame:
    """The least p-value to report, by stratum, from a histogram of p-values.

    The windows see at most BINS rows for each of a few strata.
    """
    bins = scored.groupBy(
        "stratum", F.least(F.floor(F.col("p") * BINS), F.lit(BINS - 1)).alias("bin")
    ).agg(F.count("*").alias("n"))
    stratum = Window.partitionBy("stratum")
    above = stratum.orderBy(F.desc("bin"))
    random = 2 * F.sum(F.when(F.col("bin") >= BINS // 2, F.col("n")).otherwise(0)).over(stratum)
    known = bins.withColumn("above", F.sum("n").over(above)).withColumn(
        "random", F.least(random, F.sum("n").over(stratum))
    )
    ordinary = 1 - F.col("random") * (1 - F.col("bin") / BINS) / F.col("above")
    return (
        known.filter((F.col("random") > 0) & (ordinary <= false_share))
        .groupBy("stratum")
        .agg((F.min("bin") / BINS).alias("cut"))
    )


def _text(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    parts = F.transform(
        spans,
        lambda s: F.concat_ws(
            ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")
        ),
    )
    return F.concat_ws(",", parts)


def scan(documents: DataFrame, false_share: float = FALSE_SHARE) -> DataFrame:
    """Per document: counts by kind, base spans and all spans as arrays (start, kind, end)."""
    df = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("_text"))
    for kind in KINDS:
        df = _with_matches(df, kind)
    kept = {
        "assign": F.filter(
            "_assign",
            lambda s: F.length(F.regexp_extract(s["match"], PATTERNS["assign"], 2)) >= ASSIGN_VALUE,
        ),
        "access": F.filter("_access", lambda s: F.length(s["match"]) >= ACCESS_CHARS),
        "hex": F.col("_hex"),
    }
    place = lambda s: F.struct(s["start"], s["kind"], s["end"])
    df = df.withColumns({f"_{kind}": F.transform(spans, place) for kind, spans in kept.items()})
    found = staged(
        df.select(
            F.monotonically_increasing_id().alias("_order"),
            "doc_id",
            *[F.size(f"_{k}").cast("long").alias(f"n_{k}") for k in kept],
            F.array_sort(F.concat("_assign", "_access", "_hex")).alias("base"),
            F.col("_random").alias("_tokens"),
        ),
        "spans",
    )
    tokens = found.filter(F.size("_tokens") > 0).select("_order", F.explode("_tokens").alias("_t"))
    scored = staged(
        _battery(tokens.select("_order", "_t.*")).select(
            "_order", "start", "kind", "end", "encoding", "stratum", "p"
        ),
        "tokens",
    )
    reported = (
        scored.join(cuts(scored, false_share), "stratum")
        .filter(F.col("p") > F.col("cut"))
        .groupBy("_order")
        .agg(F.collect_list(F.struct("start", "kind", "end")).alias("_more"))
    )
    return found.join(reported, "_order", "left").select(
        "doc_id",
        "n_assign",
        "n_access",
        "n_hex",
        "base",
        F.array_sort(
            F.concat("base", F.coalesce("_more", F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")))
        ).alias("all_spans"),
    )


def digest(scanned: DataFrame) -> DataFrame:
    return scanned.select(
        "doc_id",
        "n_assign",
        "n_access",
        "n_hex",
        F.sha2(_text(F.col("base")), 256).alias("base_sha256"),
        _text(F.col("all_spans")).alias("spans"),
    )

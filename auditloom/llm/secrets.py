"""Secret scan: fixed rules for known formats, and Markov models for the rest.

Everything is a DataFrame expression. Spans are found without leaving the row: the
pieces between the matches (``split``) and the matches themselves
(``regexp_extract_all``) are lengths whose running sum gives the positions.

The learned part compares two character Markov models by their log-likelihood ratio
per transition: one of random strings, trained on the values that the fixed rules have
labelled as secrets, and one of ordinary identifiers, trained on the other long tokens.
Both are counted on a sample of ``SAMPLE_DOCS`` documents with and as many without such
a value (expected number, chosen by a hash), so the size of the model is fixed.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditloom.functions.statistics import let
from auditloom.llm.text import unused
from auditloom.session import materialise

# Fixed values of the base rules. For `access` and `hex` the least length is in the
# pattern, which finds the same maximal runs; a look behind spares a try at each letter.
ASSIGN = (
    "((?i:password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ASSIGN_LEAST = 8
# finds something in every text in which ASSIGN has a match that counts
ASSIGN_HINT = ASSIGN[:-2] + "{8,})"
ACCESS = "AKIA[A-Z0-9]{12,}"
HEX = "(?<![0-9a-f])[0-9a-f]{32,}"
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
KINDS = ("assign", "access", "hex", "markov")

# a token that the models judge, and the characters it is made of
TOKEN = "(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{16,}"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-."
# tokens to learn ordinary identifiers from
IDENTIFIER = "(?<![A-Za-z0-9_-])[A-Za-z][A-Za-z0-9_-]{7,}"
SAMPLE_DOCS = 5_000
# least mean log-likelihood ratio of a secret, in nats per transition
THRESHOLD = 0.5
SPAN = "array<struct<start:int,kind:int,end:int,value:string>>"
PLACEHOLDER = "[SECRET]"


def _any(tests: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, tests)


def _has_assign(text: Column) -> Column:
    """Whether ASSIGN may have a match that counts; plain substring tests come first."""
    lower = F.lower(text)
    return (
        (F.contains(text, F.lit(":")) | F.contains(text, F.lit("=")))
        & _any([F.contains(lower, F.lit(k)) for k in KEYWORDS])
        & F.rlike(text, F.lit(ASSIGN_HINT))
    )


def _has_access(text: Column) -> Column:
    return F.contains(text, F.lit("AKIA")) & F.rlike(text, F.lit(ACCESS))


def _before(values: Column, combine, neutral: Column) -> Column:
    """For each value, all values before it combined; ``combine`` is associative.

    The array is cut into about as many blocks as a block has values. Results are appended
    inside the blocks and over their totals only, so that an array of n values costs n times
    the square root of n steps, not n squared.
    """
    side = F.greatest(F.ceil(F.sqrt(F.size(values))).cast("int"), F.lit(1))

    def inside(block: Column) -> Column:
        start = F.struct(neutral.alias("all"), F.slice(F.array(neutral), 1, 0).alias("out"))
        return F.aggregate(
            block,
            start,
            lambda state, x: F.struct(
                combine(state["all"], x).alias("all"), F.array_append(state["out"], state["all"]).alias("out")
            ),
        )

    def over(v: Column, n: Column) -> Column:
        starts = F.when(F.size(v) > 0, F.sequence(F.lit(1), F.size(v), n)).otherwise(F.array().cast("array<int>"))
        blocks = F.transform(starts, lambda i: inside(F.slice(v, i, n)))

        def joined(found: Column) -> Column:
            ahead = inside(F.transform(found, lambda x: x["all"]))["out"]
            both = F.zip_with(found, ahead, lambda x, y: F.transform(x["out"], lambda z: combine(y, z)))
            return F.flatten(both)

        return let(blocks, joined)

    return let(F.struct(values.alias("v"), side.alias("n")), lambda s: over(s["v"], s["n"]))


def _spans(text: Column, pattern: str, kind: int, test: Column) -> Column:
    """Spans of all matches, leftmost first and not overlapping; start and end in code points.

    Only texts that pass ``test`` are looked through in full.
    """
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)

    def placed(pieces: Column) -> Column:
        used = F.transform(pieces, lambda x: F.length(x["gap"]) + F.length(x["hit"]))
        starts = _before(used, lambda a, b: a + b, F.lit(0))
        return F.zip_with(
            pieces,
            starts,
            lambda x, at: F.struct(
                (at + F.length(x["gap"])).alias("start"),
                F.lit(kind).alias("kind"),
                (at + F.length(x["gap"]) + F.length(x["hit"])).alias("end"),
                x["hit"].alias("value"),
            ),
        )

    pieces = let(
        hits,
        lambda h: F.zip_with(
            F.slice(gaps, F.lit(1), F.size(h)), h, lambda gap, hit: F.struct(gap.alias("gap"), hit.alias("hit"))
        ),
    )
    return F.when(test, let(pieces, placed)).otherwise(F.array().cast(SPAN))


def _free(base: Column, tokens: Column) -> Column:
    """The tokens that overlap no base span, by one look ahead and one back in sorted order."""
    none, far = F.lit(0), F.lit(2**31 - 1)
    is_base = lambda s: s["kind"] < len(KINDS) - 1

    def kept(spans: Column) -> Column:
        ends = F.transform(spans, lambda s: F.when(is_base(s), s["end"]).otherwise(none))
        starts = F.transform(F.reverse(spans), lambda s: F.when(is_base(s), s["start"]).otherwise(far))
        # a base span comes ahead of a token that starts where it does
        last = _before(ends, lambda a, b: F.greatest(a, b), none)
        following = F.reverse(_before(starts, lambda a, b: F.least(a, b), far))
        marked = F.zip_with(
            spans,
            F.zip_with(last, following, lambda a, b: F.struct(a.alias("last"), b.alias("next"))),
            lambda s, n: F.struct(
                s.alias("s"), (~is_base(s) & (n["last"] <= s["start"]) & (n["next"] >= s["end"])).alias("free")
            ),
        )
        return F.transform(F.filter(marked, lambda m: m["free"]), lambda m: m["s"])

    found = let(F.sort_array(F.concat(base, tokens)), kept)
    return F.when((F.size(base) > 0) & (F.size(tokens) > 0), found).otherwise(tokens)


def _base(text: Column) -> Column:
    value = lambda hit: F.regexp_extract(hit, ASSIGN, 2)
    assign = F.filter(
        _spans(text, ASSIGN, 0, _has_assign(text)),
        lambda s: F.length(value(s["value"])) >= ASSIGN_LEAST,
    )
    access = _spans(text, ACCESS, 1, _has_access(text))
    return F.sort_array(F.concat(assign, access, _spans(text, HEX, 2, F.rlike(text, F.lit(HEX)))))


def _secret_values(base: Column) -> Column:
    return F.transform(
        base,
        lambda s: F.when(s["kind"] == 0, F.regexp_extract(s["value"], ASSIGN, 2)).otherwise(s["value"]),
    )


def _transitions(tokens: DataFrame) -> DataFrame:
    """How often one character follows another in the given ``token`` and ``random`` rows."""
    codes = F.transform(F.split("token", "(?!^)"), lambda c: F.instr(F.lit(ALPHABET), c) - 1)
    pairs = F.zip_with(
        F.slice("codes", F.lit(1), F.size("codes") - 1),
        F.slice("codes", F.lit(2), F.size("codes") - 1),
        lambda a, b: a * len(ALPHABET) + b,
    )
    return (
        tokens.filter(F.length("token") > 1)
        .select("random", codes.alias("codes"))
        .select("random", F.explode(pairs).alias("pair"))
        .groupBy("random", "pair")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def train(texts: DataFrame, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """One row with ``llr``, the log-likelihood ratio of each pair of characters.

    ``texts`` has a ``text`` column. Counts start at one, so an empty sample gives
    ratios of zero and nothing is found.
    """
    spark, size = texts.sparkSession, len(ALPHABET)
    share = (F.lit(float(sample_docs)) / F.greatest(F.lit(1), F.count(F.lit(1)))).alias("share")
    text = F.coalesce("text", F.lit(""))
    labelled = _has_assign(text) | _has_access(text) | F.rlike(text, F.lit(HEX))
    found = texts.select(text.alias("text"), labelled.alias("labelled"))
    # at most two rows, so its size is fixed
    shares = materialise(found.groupBy("labelled").agg(share))
    draw = F.pmod(F.xxhash64("text", F.lit("sample")), F.lit(1_000_003)) / 1_000_003
    sample = found.join(F.broadcast(shares), "labelled").filter(draw < F.col("share"))
    base = _base(F.col("text"))
    secrets = sample.filter("labelled").select(
        F.explode(_secret_values(base)).alias("token"), F.lit(True).alias("random")
    )
    ordinary = sample.filter("not labelled").select(
        F.explode(F.regexp_extract_all("text", F.lit(IDENTIFIER), F.lit(0))).alias("token"),
        F.lit(False).alias("random"),
    )
    counts = _transitions(secrets.unionByName(ordinary))
    number = lambda name, test: F.sum(F.when(test, F.col("n")).otherwise(0)).alias(name)
    per_pair = counts.groupBy("pair").agg(
        number("r", F.col("random")), number("o", ~F.col("random"))
    )
    grid = spark.range(size * size).select(F.col("id").cast("int").alias("pair"))
    full = grid.join(F.broadcast(per_pair), "pair", "left").na.fill(0, ["r", "o"])
    first = F.expr(f"div(pair, {size})").alias("first")
    totals = full.groupBy(first).agg(F.sum("r").alias("all_r"), F.sum("o").alias("all_o"))
    ratio = F.log((F.col("r") + 1) / (F.col("all_r") + size)) - F.log(
        (F.col("o") + 1) / (F.col("all_o") + size)
    )
    rated = full.withColumn("first", first).join(F.broadcast(totals), "first")
    rows = F.array_sort(F.collect_list(F.struct("pair", ratio.alias("llr"))))
    return materialise(rated.agg(rows.alias("rows")).select(F.col("rows.llr").alias("llr")))


def _score(token: Column, llr: Column) -> Column:
    """Mean log-likelihood ratio per transition."""
    codes = F.transform(F.split(token, "(?!^)"), lambda c: F.instr(F.lit(ALPHABET), c) - 1)
    step = F.aggregate(
        codes,
        F.struct(F.lit(-1).alias("last"), F.lit(0.0).alias("sum")),
        lambda state, code: F.struct(
            code.alias("last"),
            F.when(state["last"] < 0, 0.0)
            .otherwise(state["sum"] + F.get(llr, state["last"] * len(ALPHABET) + code))
            .alias("sum"),
        ),
        lambda state: state["sum"],
    )
    return step / F.greatest(F.length(token) - 1, F.lit(1))


def find_secrets(
    docs: DataFrame, model: DataFrame | None = None, threshold: float = THRESHOLD
) -> DataFrame:
    """``docs`` with ``base`` and ``spans``: arrays of (start, kind, end, value).

    Positions are code points with an exclusive end; ``kind`` numbers KINDS. A null text
    counts as empty and has no spans; other columns, null or not, are kept, except that
    columns named ``base`` and ``spans`` are replaced. Every row is judged for itself, so
    repeated rows give repeated results. Texts of any length are read whole; the work on one
    grows with its matches times the square root of their number. Learned spans are tokens of 16 characters or
    more, not all digits, that no base span overlaps.
    """
    model = train(docs.select("text")) if model is None else model
    name = unused("_secret_llr", docs.columns)
    llr = F.col(name)  # one array, evaluated once for the whole query
    text = F.coalesce("text", F.lit(""))
    tokens = F.filter(
        _spans(text, TOKEN, 3, F.rlike(text, F.lit(TOKEN))),
        lambda s: ~F.rlike(s["value"], F.lit("^[0-9]+$")),
    )
    learned = let(tokens, lambda t: F.filter(_free(F.col("base"), t), lambda x: _score(x["value"], llr) >= threshold))
    return (
        docs.withColumn(name, model.select("llr").scalar())
        .withColumn("base", _base(text))
        .withColumn("spans", F.sort_array(F.concat("base", learned)))
        .drop(name)
    )


def _joined(spans: Column) -> Column:
    name = lambda s: F.element_at(F.array(*map(F.lit, KINDS)), s["kind"] + 1)
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", name(s), s["start"], s["end"])), ",")


def digest(found: DataFrame) -> DataFrame:
    """Counts per kind, the digest of the base spans and all spans as text."""
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{name}") for k, name in enumerate(KINDS[:3])],
        F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"),
    )


def redact(found: DataFrame) -> DataFrame:
    """``found`` with each span of ``text`` replaced by PLACEHOLDER, overlapping ones by one."""
    text = F.col("text")

    def cut(state: Column) -> Column:
        chars, spans = state["chars"], state["spans"]
        ends = _before(F.transform(spans, lambda s: s["end"]), lambda a, b: F.greatest(a, b), F.lit(0))
        placed = F.zip_with(spans, ends, lambda s, at: F.struct(s["start"].alias("start"), at.alias("at")))
        # a span that begins inside an earlier one goes with that
        first = F.filter(placed, lambda p: p["start"] >= p["at"])
        pieces = F.transform(
            first,
            lambda p: F.concat(
                F.array_join(F.slice(chars, p["at"] + 1, p["start"] - p["at"]), ""), F.lit(PLACEHOLDER)
            ),
        )
        last = F.array_max(F.transform(spans, lambda s: s["end"]))
        tail = F.array_join(F.slice(chars, last + 1, F.size(chars)), "")
        return F.concat(F.array_join(pieces, ""), tail)

    chars = F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0))
    bare = F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))
    replaced = let(F.struct(chars.alias("chars"), bare.alias("spans")), cut)
    return found.withColumn("text", F.when(F.size("spans") > 0, replaced).otherwise(text))

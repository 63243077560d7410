r"""Personal data by base patterns and bootstrapped contextual extraction.

Base: e-mail addresses, IPv4 addresses, payment cards (Luhn) and international
phone numbers, by regular expression, leftmost and non-overlapping per kind.
The expressions are possessive and anchored so that their time is linear in the
text; a match that fails its check is dropped.

Texts are read in pieces of about ``PIECE`` characters, cut after a line break or before a word that begins
with a letter, where no identifier can go on; so the time spent on a text grows with its
length, however many matches it holds. Only a line of numbers without a word stays one piece.

Bootstrap: base matches are the seed entities. The two words before an
identifier (digits as 0) are its lexical pattern. Patterns and identifiers form
a graph of distinct pairs, over all documents; other tokens that hold a digit or
an @ are candidates; numbers written in groups with single blanks between them are
one. In each round a pattern's confidence for a kind is the sum
of its identifiers' scores over their number plus ``SMOOTH``, and a candidate's
score is the best confidence among its patterns, once that reaches ``TRUST`` with
at least ``SUPPORT`` seeds, and if its shape fits the kind. Scores only rise; when no
confidence rises by more than ``STILL`` any more, trusted patterns mark the fitting candidates
that follow them, in every document. Base spans always stay. No identifier is longer
than ``LONGEST`` characters (of addresses the limit that mail servers set): longer tokens
count as candidates that are none, by a digest.

The texts are read once; everything after that works on identifiers. Scores are
aggregates that combine in each task, joined to stored tables, so a pattern that
precedes a third of all identifiers is split by Spark.

Positions are code points, end exclusive. Defined cases: a null text is empty; rows alike
are rows of their own with equal spans; a null id is kept; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accesslens.llm.common import stored, text_of

KINDS = ("email", "ip", "card", "phone")
ATOM = "A-Za-z0-9._%+-"
# Each equals the plain expression of its kind: a run is only tried at its start or right after a match.
BASE = {
    "email": rf"(?:(?<![{ATOM}])|\G)[{ATOM}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9]++(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
SPACE = r"\x20\x09-\x0D"
# A number in groups: up to 19 tokens of digits and signs, as cards have up to 19 digits, the first too short to be
# an identifier by itself.
# A run is tried at its first token only; addresses, and tokens with a letter, end it.
APART = rf"(?=[^{SPACE}\p{{L}}\p{{N}}@]*+(?:[{SPACE}]|\z))"
PART = r"(?![0-9]++\.[0-9]++\.[0-9]++\.[0-9])[(]?(?:[()./-]*+[0-9]){1,%d}+[()./-]*+" + APART
GROUPS = rf"(?<![0-9)]\x20)[+]?{PART % 6}(?:\x20{PART % 19}){{1,18}}+(?!\x20{PART % 19})"
# Such a number, or a token with a digit or an @, tried at its start only; surrounding punctuation is cut off later.
TOKEN = rf"(?<![^{SPACE}])(?:{GROUPS}|[^{SPACE}0-9@]*+[0-9@][^{SPACE}]*+)"
# The last two words of a text, read backwards, or its only one.
LAST = rf"^[{SPACE}]*+([^{SPACE}]++)(?:[{SPACE}]++([^{SPACE}]++))?"
# The same, where a blank before the second shows that it is whole.
LAST_WHOLE = rf"^[{SPACE}]*+([^{SPACE}]++)[{SPACE}]++([^{SPACE}]++)[{SPACE}]"
NEAR = 256  # characters in which the two words are looked for first
CHUNK = 128
PIECE = 1024
PIECES = rf"(?s).{{{PIECE}}}.*?(?:[\x09-\x0D]|\x20(?=\p{{L}}))|.+"
LONGEST = 254
SUPPORT, SMOOTH, TRUST, STILL = 5, 2.0, 0.8, 1e-3
ENTRY = "array<struct<start:int,kind:int,end:int,instance:string>>"


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(number: Column) -> Column:
    n = F.length(number)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(number, n - i + 1, F.lit(1)).cast("int")
        return total + F.when(i % 2 == 1, d).when(d > 4, 2 * d - 9).otherwise(2 * d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10 == 0


def valid(kind: str, match: Column) -> Column:
    if kind == "ip":
        # At most 255 without leading zeros; longer parts of zeros are allowed by value.
        return ~F.exists(F.split(match, r"\."), lambda p: F.length(F.ltrim(p, F.lit("0"))) > 3) & F.forall(
            F.split(match, r"\."), lambda p: F.coalesce(p.try_cast("decimal(38,0)"), F.lit(0)) <= 255
        )
    if kind == "card":
        n = F.length(digits(match))
        return F.when((n >= 14) & (n <= 19), luhn(digits(match))).otherwise(False)
    if kind == "phone":
        return F.length(digits(match)).between(10, 15)
    return F.lit(True)


def matches(text: Column, pattern: str) -> Column:
    """All matches with their place: pieces between matches and matches, summed up in turn, in chunks and then
    from chunk to chunk, as an array that grows by one is copied every time."""
    between = F.transform(F.split(text, pattern, -1), F.length)
    found = F.regexp_extract_all(text, F.lit(pattern), 0)
    pairs = F.zip_with(between, found, lambda b, m: F.struct(b.alias("gap"), m.alias("match")))
    kind = "array<struct<start:int,end:int,match:string>>"
    zero = F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("out"))

    def add(s: Column, p: Column) -> Column:
        start = s["at"] + p["gap"]
        end = start + F.length(p["match"])
        one = F.array(F.struct(start.alias("start"), end.alias("end"), p["match"].alias("match")))
        return F.struct(end.alias("at"), F.concat(s["out"], one).alias("out"))

    def chunked(some: Column) -> Column:
        firsts = F.sequence(F.lit(1), F.size(some), F.lit(CHUNK))
        chunks = F.transform(firsts, lambda i: F.aggregate(F.slice(some, i, CHUNK), zero, add))
        return bound(chunks, together)

    def together(chunks: Column) -> Column:
        offsets = F.aggregate(
            chunks, F.array(F.lit(0)), lambda s, c: F.concat(s, F.array(F.element_at(s, -1) + c["at"]))
        )
        return bound(offsets, lambda o: F.flatten(F.transform(chunks, lambda c, i: moved(c["out"], F.get(o, i)))))

    def moved(out: Column, by: Column) -> Column:
        return F.transform(
            out, lambda m: F.struct((m["start"] + by).alias("start"), (m["end"] + by).alias("end"), m["match"].alias("match"))
        )

    def summed(some: Column) -> Column:
        whole = F.aggregate(some, zero, add, lambda s: s["out"])
        return F.when(F.size(some) <= CHUNK, whole).otherwise(chunked(some))

    return bound(F.filter(pairs, lambda p: p["match"].isNotNull()), summed)


def bound(value: Column, use) -> Column:
    """``use`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def base_spans(text: Column) -> Column:
    """Valid base matches of all kinds, unsorted."""
    hints = {"email": "@", "phone": "+"}

    def of(number: int, kind: str) -> Column:
        kept = F.filter(matches(text, BASE[kind]), lambda m: valid(kind, m["match"]))
        entries = F.transform(
            kept,
            lambda m: F.struct(
                m["start"].alias("start"), F.lit(number).alias("kind"), m["end"].alias("end"), m["match"].alias("instance")
            ),
        ).cast(ENTRY)
        hint = F.contains(text, F.lit(hints[kind])) if kind in hints else text.rlike("[0-9]")
        return F.when(hint, entries).otherwise(F.array().cast(ENTRY))

    return F.concat(*[of(i, k) for i, k in enumerate(KINDS)])


def candidates(text: Column, base: Column) -> Column:
    """Other tokens with a digit or an @, and numbers in groups, without the punctuation around them, kind -1."""
    core = r"(?s)^[^\p{L}\p{N}(+]*(.*?)[^\p{L}\p{N})]*$"

    def trimmed(m: Column) -> Column:
        inner = F.regexp_extract(m["match"], core, 1)
        start = m["start"] + F.length(F.regexp_extract(m["match"], r"^[^\p{L}\p{N}(+]*", 0))
        return F.struct(
            start.alias("start"), F.lit(-1).alias("kind"), (start + F.length(inner)).alias("end"), inner.alias("instance")
        )

    tokens = F.transform(matches(text, TOKEN), trimmed)
    free = F.filter(
        tokens,
        lambda t: (F.length(t["instance"]) > 0)
        & ~F.exists(base, lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"])),
    ).cast(ENTRY)
    return F.when(text.rlike("[0-9@]"), free).otherwise(F.array().cast(ENTRY))


def words_of(back: Column, pattern: str) -> Column:
    """Two words of a text that stands backwards."""
    return F.trim(F.concat_ws(" ", F.reverse(F.regexp_extract(back, pattern, 2)), F.reverse(F.regexp_extract(back, pattern, 1))))


def last_words(text: Column) -> Column:
    """The last two words of a text, or its only one, joined by a blank; empty if it has none."""
    return words_of(F.reverse(text), LAST)


def pattern_before(text: Column, start: Column, tail: Column) -> Column:
    """The two words before a place, in lower case, digits as 0; a text that ``tail`` ends goes on with ``text``.
    At the start of a text the only one; empty if there are none."""
    first = F.greatest(start - NEAR, F.lit(0))
    near = words_of(F.reverse(F.substring(text, first + 1, start - first)), LAST_WHOLE)
    every = last_words(F.concat(tail, F.lit(" "), F.substring(text, F.lit(1), start)))
    words = bound(near, lambda found: F.when(found != "", found).otherwise(every))
    return F.regexp_replace(F.lower(words), "[0-9]", "0")


def pieces(docs: DataFrame) -> DataFrame:
    """``row``, ``doc_id``, ``at`` (place in the text), ``text``, ``tail`` (the words before): all texts in pieces."""
    text = text_of(docs)
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", text.alias("text"))
    whole = F.length("text") <= PIECE
    cut = F.when(whole, F.array("text")).otherwise(F.regexp_extract_all("text", F.lit(PIECES), 0))
    rows = rows.withColumn("pieces", cut)
    zero = F.struct(
        F.lit(0).alias("at"), F.lit("").alias("tail"), F.array().cast("array<struct<at:int,tail:string>>").alias("out")
    )

    def add(s: Column, p: Column) -> Column:
        here = F.array(F.struct(s["at"].alias("at"), s["tail"].alias("tail")))
        after = last_words(F.concat(s["tail"], F.lit(" "), p))
        return F.struct((s["at"] + F.length(p)).alias("at"), after.alias("tail"), F.concat(s["out"], here).alias("out"))

    start = F.array(F.struct(F.lit(0).alias("at"), F.lit("").alias("tail")))
    places = F.when(F.size("pieces") == 1, start).otherwise(F.aggregate("pieces", zero, add, lambda s: s["out"]))
    each = rows.select("row", "doc_id", F.inline(F.arrays_zip(F.col("pieces").alias("text"), places.alias("place"))))
    return each.select("row", "doc_id", "text", "place.at", "place.tail")


def found_in(docs: DataFrame) -> DataFrame:
    """Per piece: ``row``, ``doc_id``, ``base`` and ``seen`` (base and candidates with their pattern). The only
    step that reads texts."""
    rows = pieces(docs)
    rows = rows.withColumn("base", base_spans(F.col("text")))
    rows = rows.withColumn("free", candidates(F.col("text"), F.col("base")))

    def moved(e: Column) -> tuple[Column, ...]:
        return (e["start"] + F.col("at")).alias("start"), e["kind"], (e["end"] + F.col("at")).alias("end")

    def seen(e: Column) -> Column:
        long = (e["kind"] < 0) & (F.length(e["instance"]) > LONGEST)
        instance = F.when(long, F.concat(F.lit("long "), F.md5(e["instance"].cast("binary")))).otherwise(e["instance"])
        return F.struct(*moved(e), instance.alias("instance"), pattern_before(F.col("text"), e["start"], F.col("tail")).alias("pattern"))

    return rows.select(
        "row", "doc_id", F.transform("base", lambda e: F.struct(*moved(e))).alias("base"),
        F.transform(F.concat("base", "free"), seen).alias("seen"),
    )


def shape_fits(kind: Column, instance: Column) -> Column:
    """Whether an unseen identifier may be of the kind."""
    n = F.length(digits(instance))
    email = instance.rlike(r"^[^@]+@[^@]+$")
    ip = instance.rlike(r"^[0-9A-Fa-f:.]{7,}$") & (n >= 4)
    card = instance.rlike(r"^[0-9. -]+$") & (n >= 12) & (n <= 19)
    # Groups have an area code, so more digits.
    phone = instance.rlike(r"^[+(]?[0-9][0-9() ./-]*$") & (n >= F.when(instance.contains(" "), 8).otherwise(7)) & (n <= 15)
    return F.when(kind == 0, email).when(kind == 1, ip).when(kind == 2, card).otherwise(phone)


def trusted_patterns(seen: DataFrame, still: float = STILL) -> DataFrame:
    """``seen`` (pattern, instance, kind), stored, -1 for candidates. Rows ``pattern``, ``kind``."""
    pairs = stored(
        seen.filter(F.col("pattern") != "").groupBy("pattern", "instance").agg(F.max("kind").alias("seed")), "pairs"
    )
    seeds = pairs.filter("seed >= 0").select("instance", F.col("seed").alias("kind"), F.lit(1.0).alias("score")).distinct()
    seeds = stored(seeds, "seeds")
    sizes = stored(pairs.groupBy("pattern").agg(F.count(F.lit(1)).alias("all")), "sizes")
    scores, before = seeds, None
    while True:
        # An identifier scores for the kinds it is known for; every other one counts as against.
        known = pairs.join(scores, "instance").groupBy("pattern", "kind").agg(
            F.sum("score").alias("gain"), F.count_if(F.col("seed") >= 0).alias("seeds")
        )
        rated = known.filter(F.col("seeds") >= SUPPORT).join(sizes, "pattern")
        confidence = F.col("gain") / (F.col("all") + SMOOTH)
        trusted = stored(
            rated.select("pattern", "kind", confidence.alias("score")).filter(F.col("score") >= TRUST), "trusted"
        )
        if before is not None:
            old = before.withColumnRenamed("score", "old")
            risen = trusted.join(old, ["pattern", "kind"], "left").filter(F.col("score") > F.coalesce("old", F.lit(0.0)) + still)
            if risen.isEmpty():
                return trusted.select("pattern", "kind")
        before = trusted
        new = (
            pairs.filter("seed < 0")
            .join(trusted, "pattern")
            .filter(shape_fits(F.col("kind"), F.col("instance")))
            .groupBy("instance", "kind")
            .agg(F.max("score").alias("score"))
        )
        scores = stored(seeds.unionAll(new), "scores")


def joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            F.array_sort(spans),
            lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def of_kind(number: int):
    return lambda span: span["kind"] == number


def personal_data(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id``, ``n_email`` ... ``n_phone`` (base), ``base_sha256``, ``spans`` (all)."""
    found = stored(found_in(docs), "found")
    seen = found.select("row", F.explode("seen").alias("s")).select("row", "s.*")
    trusted = trusted_patterns(seen.select("pattern", "instance", "kind"))
    free = seen.filter("kind < 0").drop("kind").join(trusted, "pattern").filter(shape_fits(F.col("kind"), F.col("instance")))
    span = F.struct("start", "kind", "end")
    added = free.groupBy("row").agg(F.collect_set(span).alias("added"))
    # The pieces of a text together again.
    rows = found.groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.flatten(F.collect_list("base")).alias("base"))
    rows = rows.join(added, "row", "left")
    counts = [F.size(F.filter("base", of_kind(i))).cast("long").alias(f"n_{kind}") for i, kind in enumerate(KINDS)]
    every = F.when(F.col("added").isNull(), F.col("base")).otherwise(F.concat("base", "added"))
    return rows.select(
        "doc_id", *counts, F.sha2(joined(F.col("base")).cast("binary"), 256).alias("base_sha256"), joined(every).alias("spans")
    )

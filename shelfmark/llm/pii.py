"""Information-theoretic sanitisation of personal data, by DataFrame functions only.

Base spans are the emails, IP addresses, card and phone numbers of a text. Each distinct
value is a protected entity. Terms that stand near an entity are its context; how much a
term tells about it is estimated from the whole corpus: with c occurrences of the term
near the entity and f in all, PMI = log2(c N / (f e)) and the information of the entity is
IC = log2(N / e), so the term leaves IC - PMI = log2(f / c) bits open. A term that leaves
at most ``max_bits`` open, with ``min_support`` occurrences, discloses the entity. It is
generalised to its first letters if these leave more bits open, else removed.

Offsets are code points from 0, end exclusive. Defined cases: a null text is empty and has
no spans; every input row gives one row; rows with one id and one text give equal rows;
a context ends at a line end; an empty table gives an empty result; an input column that
has the name of an added one is not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.session import written

#: Fixed kinds and their order.
KINDS = ("email", "ip", "card", "phone")
#: The patterns, written so that no text takes more than linear time: a match starts where a
#: run of its first class starts (or where the last match ended), and no loop gives back.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # a whole run of digits, single blanks or hyphens between them, of 16 to 19 digits
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?+[0-9]){15,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold for a match at all: found much faster than the match.
HINT = {"email": "@", "ip": ".", "phone": "+"}
IP_PARTS = r"^0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})(?:\.0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})){3}$"
LETTERS = r"\p{L}{3,}"
CONTEXT = 64
#: Terms up to this number (a few MB) are sent to all tasks; beyond, word counts are joined by a shuffle.
BROADCAST_TERMS = 200_000
SPAN = "array<struct<kind:int,start:bigint,end:bigint,value:string,left:string,right:string>>"
_CHUNK = 128


def running_sums(numbers: Column) -> Column:
    """The running sums of an array, by chunks, so that long arrays stay cheap."""
    grow = lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x))
    zero = F.array(F.lit(0).cast("long"))
    chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size(numbers) - 1) / _CHUNK).cast("int")), lambda c: F.slice(numbers, c * _CHUNK + 1, _CHUNK))
    local = F.transform(chunks, lambda c: F.aggregate(c, zero, grow))
    base = F.aggregate(F.transform(local, lambda c: F.element_at(c, -1)), zero, grow)
    return F.flatten(F.transform(F.arrays_zip(local.alias("sums"), F.slice(base, 1, F.size(local)).alias("base")), lambda z: F.transform(F.slice(z["sums"], 2, _CHUNK), lambda x: x + z["base"])))


def luhn(digits: Column) -> Column:
    """The Luhn test of a short string of digits."""
    places = F.sequence(F.lit(1), F.length(digits))
    value = lambda i: F.substring(F.reverse(digits), i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
    total = F.aggregate(F.transform(places, lambda i: F.when(value(i) > 9, value(i) - 9).otherwise(value(i))), F.lit(0), lambda a, x: a + x)
    return total % 10 == 0


def _passes(kind: str, value: Column) -> Column:
    digits = F.length(F.regexp_replace(value, "[^0-9]", ""))
    if kind == "ip":
        return value.rlike(IP_PARTS)
    if kind == "card":
        return luhn(F.translate(value, " -", ""))
    if kind == "phone":
        return digits.between(8, 15)
    return F.lit(True)


def base_spans(docs: DataFrame) -> DataFrame:
    """doc_id, row (id and text hash) and the base spans with their contexts of every row.

    A text is cut at the matches, so places come from the lengths of matches and of the
    parts between them.
    """
    out = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    row = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.md5("text"))
    for n, kind in enumerate(KINDS):
        pattern = F.lit(PATTERNS[kind])
        maybe = F.instr("text", HINT[kind]) > 0 if kind in HINT else F.lit(True)
        none = F.array().cast("array<string>")
        out = out.withColumn("found", F.when(maybe, F.regexp_extract_all("text", pattern, F.lit(0))).otherwise(none))
        out = out.withColumn("parts", F.when(F.size("found") > 0, F.split("text", PATTERNS[kind], -1)).otherwise(none))
        steps = F.zip_with(F.slice("parts", 1, F.size("found")), "found", lambda p, f: (F.length(p) + F.length(f)).cast("long"))
        out = out.withColumn("ends", F.when(F.size("found") > 0, running_sums(steps)).otherwise(F.array().cast("array<bigint>")))
        left = lambda p: F.substring_index(F.right(p, F.lit(CONTEXT)), "\n", -1)
        right = lambda p: F.substring_index(F.left(p, F.lit(CONTEXT)), "\n", 1)
        zipped = F.arrays_zip(F.col("found").alias("value"), F.col("ends").alias("end"), F.slice("parts", 1, F.size("found")).alias("before"), F.slice("parts", 2, F.size("found")).alias("after"))
        kept = F.transform(
            F.filter(zipped, lambda z: _passes(kind, z["value"])),
            lambda z: F.struct(
                F.lit(n).alias("kind"), (z["end"] - F.length(z["value"])).alias("start"), z["end"].alias("end"), z["value"].alias("value"),
                # a word that the context's edge may cut is left out
                F.when((F.length(z["before"]) > CONTEXT) & (F.instr(F.right(z["before"], F.lit(CONTEXT)), "\n") == 0), F.regexp_replace(left(z["before"]), r"^\p{L}+", "")).otherwise(left(z["before"])).alias("left"),
                F.when((F.length(z["after"]) > CONTEXT) & (F.instr(F.left(z["after"], F.lit(CONTEXT)), "\n") == 0), F.regexp_replace(right(z["after"]), r"\p{L}+$", "")).otherwise(right(z["after"])).alias("right"),
            ),
        )
        out = out.withColumn(kind, F.when(F.size("found") > 0, kept).otherwise(F.array().cast(SPAN)).cast(SPAN))
    return out.select("doc_id", row.alias("row"), F.concat(*KINDS).alias("base"))


def entity(span: Column) -> Column:
    """The protected value: emails without case, numbers without their punctuation."""
    plain = F.when(span["kind"] >= 2, F.regexp_replace(span["value"], "[^0-9]", "")).otherwise(F.lower(span["value"]))
    return F.concat_ws(":", span["kind"].cast("string"), plain)


def context_terms(base: DataFrame) -> DataFrame:
    """The words near entities: row, entity, term, start, end; none that lies in a base span."""
    spans = F.transform("base", lambda b: F.struct(b["start"].alias("start"), b["end"].alias("end")))
    one = base.where(F.size("base") > 0).select("row", spans.alias("spans"), F.explode("base").alias("b"))
    sides = F.array(
        F.struct((F.col("b.start") - F.length("b.left")).alias("at"), F.col("b.left").alias("text")),
        F.struct(F.col("b.end").alias("at"), F.col("b.right").alias("text")),
    )
    side = one.select("row", "spans", entity(F.col("b")).alias("entity"), F.explode(sides).alias("s")).where(F.length("s.text") > 0)
    side = side.withColumn("found", F.regexp_extract_all("s.text", F.lit(LETTERS), F.lit(0))).where(F.size("found") > 0)
    side = side.withColumn("parts", F.split("s.text", LETTERS, -1))
    ends = running_sums(F.zip_with(F.slice("parts", 1, F.size("found")), "found", lambda p, f: (F.length(p) + F.length(f)).cast("long")))
    words = F.arrays_zip(F.col("found").alias("word"), ends.alias("end"))
    word = side.select("row", "spans", "entity", F.col("s.at").alias("at"), F.explode(words).alias("w"))
    end = F.col("at") + F.col("w.end")
    placed = word.select("row", "spans", "entity", F.lower("w.word").alias("term"), (end - F.length("w.word")).alias("start"), end.alias("end"))
    free = ~F.exists("spans", lambda s: (s["start"] < F.col("end")) & (F.col("start") < s["end"]))
    return placed.where(free).drop("spans").distinct()


def general(term: Column) -> Column:
    """The generalised form: the first three letters."""
    return F.concat(F.substring(term, 1, 3), F.lit("*"))


def corpus_counts(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """How often each key (a word, or a generalised form) occurs in all texts."""
    words = docs.select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit(LETTERS), F.lit(0))).alias("word"))
    both = words.select(F.explode(F.array(F.col("word"), general(F.col("word")))).alias("key"))
    if keys.count() <= BROADCAST_TERMS:
        return both.join(F.broadcast(keys), "key", "left_semi").groupBy("key").agg(F.count(F.lit(1)).alias("f"))
    return both.groupBy("key").agg(F.count(F.lit(1)).alias("f")).join(keys, "key", "left_semi")


def disclosing(docs: DataFrame, near: DataFrame, max_bits: float = 1.0, min_support: int = 3) -> DataFrame:
    """entity, term, bits left open, and whether the term must be removed (else generalised)."""
    pairs = near.groupBy("entity", "term").agg(F.count(F.lit(1)).alias("c")).withColumn("short", general(F.col("term")))
    pairs = written(pairs, "pii-pairs")
    often = pairs.where(F.col("c") >= min_support)
    keys = written(often.select(F.explode(F.array("term", "short")).alias("key")).distinct(), "pii-keys")
    counts = written(corpus_counts(docs, keys), "pii-counts")
    shorts = pairs.groupBy("entity", "short").agg(F.sum("c").alias("short_c"))
    bits = lambda f, c: F.log2(F.greatest(F.col(f), F.col(c)) / F.col(c))
    return (
        often.join(counts.select(F.col("key").alias("term"), "f"), "term")
        .withColumn("bits", bits("f", "c"))
        .where(F.col("bits") <= max_bits)
        .join(shorts, ["entity", "short"])
        .join(counts.select(F.col("key").alias("short"), F.col("f").alias("short_f")), "short")
        .select("entity", "term", "bits", (bits("short_f", "short_c") <= max_bits).alias("remove"))
    )


def find_spans(docs: DataFrame, max_bits: float = 1.0, min_support: int = 3) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): base spans and disclosing terms, both in order."""
    base = written(base_spans(docs), "pii-base")
    near = written(context_terms(base), "pii-context")
    told = disclosing(docs, near, max_bits, min_support)
    terms = (
        near.join(told, ["entity", "term"])
        .groupBy("row", "start", "end")
        .agg(F.max("remove").alias("remove"), F.min("term").alias("term"))
        .groupBy("row")
        .agg(F.sort_array(F.collect_list(F.struct("start", "end", "term", "remove"))).alias("terms"))
    )
    empty = F.array().cast("array<struct<start:bigint,end:bigint,term:string,remove:boolean>>")
    return base.join(terms, "row", "left").select("doc_id", "row", "base", F.coalesce("terms", empty).alias("terms"))


def span_texts(kinds: tuple[str, ...] = KINDS) -> Column:
    """kind:start:end of each base span, in order."""
    name = lambda b: F.element_at(F.array(*[F.lit(k) for k in kinds]), b["kind"] + 1)
    return F.transform("base", lambda b: F.concat_ws(":", name(b), b["start"].cast("string"), b["end"].cast("string")))


def sanitise(docs: DataFrame, **options) -> DataFrame:
    """doc_id and the sanitised text: values become their kind, terms their first letters or nothing."""
    spans = find_spans(docs, **options).select("row", "base", "terms").dropDuplicates(["row"])
    row = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.md5("text"))
    texts = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text")).withColumn("row", row)
    name = lambda b: F.concat(F.lit("["), F.upper(F.element_at(F.array(*[F.lit(k) for k in KINDS]), b["kind"] + 1)), F.lit("]"))
    marks = F.array_sort(
        F.concat(
            F.transform("base", lambda b: F.struct(b["start"].alias("start"), b["end"].alias("end"), name(b).alias("new"))),
            F.transform("terms", lambda t: F.struct(t["start"].alias("start"), t["end"].alias("end"), F.when(t["remove"], F.lit("")).otherwise(general(t["term"])).alias("new"))),
        )
    )
    # spans that overlap become one, with the first one's replacement
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("out"))
    step = lambda a, m: F.struct(
        F.greatest(a["at"], m["end"]).alias("at"),
        F.when(m["start"] < a["at"], a["out"]).otherwise(F.concat(a["out"], F.array(F.substring(F.col("text"), a["at"] + 1, m["start"] - a["at"]), m["new"]))).alias("out"),
    )
    done = texts.join(spans, "row").withColumn("_done", F.aggregate(marks, start, step))
    return done.select("doc_id", F.concat(F.array_join("_done.out", ""), F.substring(F.col("text"), F.col("_done.at") + 1, F.length("text"))).alias("text"))

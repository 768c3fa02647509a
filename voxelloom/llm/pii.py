"""Personal data: patterns with checks, and information-theoretic sanitisation of terms that give protected entities away.

Base: e-mail addresses, IPv4 addresses, card numbers and phone numbers, each by its pattern, leftmost and non-overlapping, then checked
(address parts up to 255, Luhn's sum, numbers of digits); a match that fails is dropped.

Method: an entity is a kind and a normalised value. A term is a word of at least four letters; its context with an entity is the CONTEXT
characters on either side of a mention. Over the whole corpus, the share of the documents with the term that mention the entity, anywhere, is drawn towards the
entity's share of all documents, which counts as PRIOR observations: that is p(entity | term). The gain in bits is log2 of the undrawn share over p(entity). Observations are the
different contexts that have the term, or, of documents that have it elsewhere, their different first contexts with the entity, whichever are more: copies of a passage count once.
Terms with p of at least GENERALISE and a gain of at least LEAST_BITS disclose the entity: in documents that mention it they are
generalised to [TERM], and from REMOVE on removed. One observation gives p = 1/3 at most for an entity that is rare enough to gain LEAST_BITS, so it never
discloses: a word seen once beside an address seen once is no evidence that it belongs to the holder.

Everything is DataFrame functions. Texts with no "@", digit or "+" skip the patterns that need one. The patterns begin either after a character that can't continue
a match backwards or where the last match ended (\\G), and their repetitions are possessive; neither changes a match, but long runs take linear time. Matches are placed, and texts sanitised, in time in proportion to the text, however many there are.
Of the texts only those with base matches leave their scan, as their distinct terms. Broadcast: the candidate terms, and the disclosing terms of documents, each only if they are at most BROADCAST_TERMS; beyond it
they meet the documents through a shuffle.

Cases: an empty table gives no rows; texts may be of any length; ties don't occur, as spans are sorted by start, then kind; null is the empty text, with no spans. Rows that agree in id and text are one document and get equal spans. Other columns are kept;
those named like the added ones are replaced.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import others, prefix, scratch

KINDS = ("email", "ip", "card", "phone", "term")
CONTEXT, PRIOR, GENERALISE, REMOVE, LEAST_BITS, BROADCAST_TERMS = 60, 2, 0.5, 0.9, 3.0, 100_000
#: Values of an array that one fold goes over; code points of a block of text.
RUN, BLOCK = 32, 1024

PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]{1,2})"
_IP = rf"^{_BYTE}\.{_BYTE}\.{_BYTE}\.{_BYTE}$"
_TERM = r"(?<![\p{L}0-9@._%+-])\p{L}{4,}(?![\p{L}0-9@_%+-])"
_WORD_BREAK = r"[^\p{L}]+"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the sum of the digits, every second from the right doubled and cast out by nines, is divisible by ten."""
    places = F.split(F.reverse(digits), "")
    pairs = F.zip_with(places, F.sequence(F.lit(0), F.size(places) - 1), lambda d, i: F.struct(d.cast("int").alias("d"), (i % 2).alias("odd")))
    worth = lambda x: F.when(x.odd == 0, x.d).when(x.d > 4, x.d * 2 - 9).otherwise(x.d * 2)
    return F.aggregate(F.filter(pairs, lambda x: x.d.isNotNull()), F.lit(0), lambda acc, x: acc + worth(x)) % 10 == 0


def _checked(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(_IP)
    if kind == "card":
        d = _digits(value)
        return F.when(F.length(d).between(14, 19), _luhn(d)).otherwise(False)
    if kind == "phone":
        return F.length(_digits(value)).between(10, 15)
    return F.lit(True)


def _guard(kind: str, text: Column) -> Column:
    return {"email": F.contains(text, F.lit("@")), "phone": F.contains(text, F.lit("+"))}.get(kind, text.rlike("[0-9]"))


_SPAN = "array<struct<start: int, end: int, value: string, before: string, after: string>>"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is worked out once."""
    return F.transform(F.array(value), body)[0]


def _before(values: Column, step: Callable[[Column, Column], Column], levels: int = 3) -> Column:
    """What step (a sum, a maximum) has made, from 0 on, of the values in front of each value of an array of int.

    A fold that appends copies what it has, so it only runs over RUN values at a time: runs are folded, then, level by level, the runs' results, and each run starts from what is in front of it. That takes time in proportion to the array."""
    fold = lambda v: F.aggregate(v, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")), lambda acc, x: F.struct(step(acc.at, x).alias("at"), F.concat(acc.out, F.array(acc.at)).alias("out")), lambda acc: acc.out)
    if levels == 1:
        return fold(values)
    whole = lambda v: F.aggregate(v, F.lit(0), step)

    def of(v: Column) -> Column:
        runs = F.transform(F.sequence(F.lit(0), F.floor((F.size(v) - 1) / RUN).cast("int")), lambda i: F.slice(v, i * RUN + 1, RUN))
        return _let(runs, lambda r: F.flatten(F.zip_with(r, _before(F.transform(r, whole), step, levels - 1), lambda run, at: F.transform(fold(run), lambda x: step(at, x)))))

    return _let(values, lambda v: F.when(F.size(v) > 0, of(v)).otherwise(F.array().cast("array<int>")))


def _located(text: Column, pattern: Column) -> Column:
    """All matches of the pattern: start, end (code points, exclusive), value, and the text between it and the matches beside it."""
    found = F.struct(F.split(text, pattern, -1).alias("pieces"), F.regexp_extract_all(text, pattern, F.lit(0)).alias("values"))

    def spans(x: Column) -> Column:
        n = F.size(x["values"])
        sizes = F.zip_with(F.slice(x.pieces, F.lit(1), n), x["values"], lambda b, v: F.length(b) + F.length(v))
        at = F.zip_with(_before(sizes, lambda s, d: s + d), x["values"], lambda i, v: F.struct(i.alias("i"), v.alias("v")))
        beside = F.zip_with(F.slice(x.pieces, F.lit(1), n), F.slice(x.pieces, F.lit(2), n), lambda b, a: F.struct(b.alias("b"), a.alias("a")))

        def one(p: Column, q: Column) -> Column:
            start = p.i + F.length(q.b)
            return F.struct(start.alias("start"), (start + F.length(p.v)).alias("end"), p.v.alias("value"), F.right(q.b, F.lit(CONTEXT)).alias("before"), F.left(q.a, F.lit(CONTEXT)).alias("after"))

        return F.when(n > 0, F.zip_with(at, beside, one)).otherwise(F.array().cast(_SPAN))

    return _let(found, spans)


def base_matches(text: Column, kind: str) -> Column:
    """The checked matches of a kind."""
    found = F.filter(_located(text, F.lit(PATTERNS[kind])), lambda m: _checked(kind, m.value))
    return F.when(_guard(kind, text), found).otherwise(F.array().cast(_SPAN))


def _based(docs: DataFrame, doc_id: str, text: str, p: str) -> DataFrame:
    """docs with the base matches of each kind and the row's identity, in columns that begin with p."""
    t = F.coalesce(F.col(text), F.lit(""))
    return docs.withColumns({f"{p}id": F.col(doc_id), f"{p}hash": F.xxhash64(F.col(text)), **{f"{p}{k}": base_matches(t, k) for k in KINDS[:4]}})


def _value(kind: Column, value: Column) -> Column:
    return F.when(kind == "email", F.lower(value)).when(kind == "ip", value).otherwise(_digits(value))


def mentions(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row for each document with base matches: _id, _hash (of the text), found (array of kind, value (normalised) and context, the sorted distinct terms beside it), words (its distinct terms). Rows that agree in id and text are one document."""
    of_kind = lambda k: F.transform(F.col(f"_{k}"), lambda m: F.struct(F.lit(k).alias("kind"), m.alias("m")))
    each = _based(docs.select(F.col(doc_id).alias("d"), F.col(text).alias("t")), "d", "t", "_").withColumn("_all", F.concat(*[of_kind(k) for k in KINDS[:4]]))

    def one(x: Column) -> Column:
        # A window's first and last characters may be a part of a word.
        around = F.concat(F.regexp_replace(x.m.before, r"^\S+", ""), F.lit(" "), F.regexp_replace(F.coalesce(x.m.after, F.lit("")), r"\S+$", ""))
        terms = F.array_sort(F.array_distinct(F.regexp_extract_all(F.lower(around), F.lit(_TERM), F.lit(0))))
        return F.struct(x.kind.alias("kind"), _value(x.kind, x.m.value).alias("value"), terms.alias("context"))

    words = F.array_distinct(F.regexp_extract_all(F.lower("t"), F.lit(_TERM), F.lit(0)))
    found = scratch(each.where(F.size("_all") > 0).select("_id", "_hash", F.transform("_all", one).alias("found"), words.alias("words")), "pii-mentions")
    if found.count() != found.select("_id", "_hash").distinct().count():
        found = scratch(found.dropDuplicates(["_id", "_hash"]), "pii-mentions")
    return found


def associations(docs: DataFrame, found: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The terms that occur with an entity in two observations or more: kind, value, term, n_both (documents with both), n_seen (observations), n_entity, n_term, p, bits. found: mentions(docs).

    Left out before their documents are counted are terms that are beside so many other entities that p can't reach GENERALISE."""
    each = found.select("_id", "_hash", F.inline("found"))
    near = each.select("_id", "_hash", "kind", "value", F.explode("context").alias("term"), F.xxhash64("context").alias("c"))
    near = near.groupBy("kind", "value", "term").agg(F.count_distinct(F.struct("_id", "_hash")).alias("n_both"), F.count_distinct("c").alias("n_seen"))
    # Elsewhere in a document: only entities of different first contexts can have two observations there.
    per_doc = scratch(each.groupBy("_id", "_hash", "kind", "value").agg(F.xxhash64(F.min("context")).alias("first")), "pii-entities-by-document")
    several = per_doc.groupBy("kind", "value").agg(F.min("first").alias("low"), F.max("first").alias("high"), F.count("*").alias("n_entity"))
    several = scratch(several, "pii-entities")
    shared = per_doc.join(several.where("low <> high"), ["kind", "value"], "left_semi")
    word = found.select(F.col("_id").alias("_wi"), F.col("_hash").alias("_wh"), "words")
    whole = shared.join(word, F.col("_id").eqNullSafe(F.col("_wi")) & F.col("_hash").eqNullSafe(F.col("_wh"))).select("kind", "value", "first", F.explode("words").alias("term"))
    whole = whole.groupBy("kind", "value", "term", "first").agg(F.count("*").alias("n")).groupBy("kind", "value", "term").agg(F.sum("n").alias("n_both"), F.count("*").alias("n_seen"))
    pairs = near.unionByName(whole).groupBy("kind", "value", "term").agg(F.max("n_both").alias("n_both"), F.max("n_seen").alias("n_seen"))
    # A term is in as many documents, at least, as have it beside any entity: where that alone holds p below GENERALISE, its documents needn't be counted.
    beside = each.select("_id", "_hash", F.explode("context").alias("term")).distinct().groupBy("term").agg(F.count("*").alias("n_beside"))
    pairs = pairs.where(F.col("n_seen") >= 2).join(beside, "term", "left").where(F.col("n_both") >= GENERALISE * F.coalesce("n_beside", F.lit(0))).drop("n_beside")
    pairs = scratch(pairs, "pii-pairs")
    terms = pairs.select("term").distinct()
    ids = docs.select(F.col(doc_id).alias("_i"), F.xxhash64(text).alias("_h"), F.col(text).alias("_t"))
    words = lambda d: d.select("_i", "_h", F.explode(F.array_distinct(F.split(F.lower("_t"), _WORD_BREAK))).alias("term"))
    if (n := terms.count()) == 0:
        none = [F.lit(0).cast("bigint").alias(c) for c in ("n_entity", "n_term")]
        return pairs.select("*", *none, F.lit(0.0).alias("p"), F.lit(0.0).alias("bits"))
    if n <= BROADCAST_TERMS:
        rows = words(ids).join(F.broadcast(terms), "term", "left_semi").groupBy("term").agg(F.count("*").alias("n_rows"))
    else:
        rows = words(ids).groupBy("term").agg(F.count("*").alias("n_rows")).join(terms, "term", "left_semi")
    # A document counts once, however many rows repeat it: what the repeats add is taken off.
    repeats = scratch(ids.groupBy("_i", "_h").agg(F.count("*").alias("c")).where("c > 1"), "pii-repeats")
    n_repeated, n_extra = repeats.agg(F.count("*"), F.coalesce(F.sum(F.col("c") - 1), F.lit(0))).first()
    with_term = rows.withColumnRenamed("n_rows", "n_term")
    if n_repeated:
        known = repeats.select(F.col("_i").alias("_ri"), F.col("_h").alias("_rh"))
        again = ids.join(F.broadcast(known) if n_repeated <= BROADCAST_TERMS else known, F.col("_i").eqNullSafe(F.col("_ri")) & F.col("_h").eqNullSafe(F.col("_rh")), "left_semi")
        extra = words(again).groupBy("_i", "_h", "term").agg((F.count("*") - 1).alias("c")).groupBy("term").agg(F.sum("c").alias("extra"))
        with_term = rows.join(extra, "term", "left").select("term", (F.col("n_rows") - F.coalesce("extra", F.lit(0))).alias("n_term"))
    total = F.lit(docs.count() - n_extra)
    share = F.least(F.lit(1.0), F.col("n_both") / F.col("n_term"))
    p = (share * F.col("n_seen") + PRIOR * F.col("n_entity") / total) / (F.col("n_seen") + PRIOR)
    bits = F.log2(share * total / F.col("n_entity"))
    joined = pairs.join(with_term, "term").join(several.select("kind", "value", "n_entity"), ["kind", "value"])
    return joined.select("kind", "value", "term", "n_both", "n_seen", "n_entity", "n_term", p.alias("p"), bits.alias("bits"))


def disclosures(docs: DataFrame, found: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The terms that give an entity away: kind, value, term, p, bits."""
    return associations(docs, found, doc_id, text).where((F.col("p") >= GENERALISE) & (F.col("bits") >= LEAST_BITS)).select("kind", "value", "term", "p", "bits")


def thresholds(pairs: DataFrame) -> DataFrame:
    """How many of associations() each threshold leaves out, and how many disclose: n_pairs, n_below_p, n_below_bits, n_disclose, n_removed (of those that disclose)."""
    low_p, low_bits = F.col("p") < GENERALISE, F.col("bits") < LEAST_BITS
    return pairs.agg(F.count("*").alias("n_pairs"), F.count_if(low_p).alias("n_below_p"), F.count_if(low_bits).alias("n_below_bits"), F.count_if(~low_p & ~low_bits).alias("n_disclose"), F.count_if(~low_bits & (F.col("p") >= REMOVE)).alias("n_removed"))


def _wanted(found: DataFrame, disclosed: DataFrame) -> DataFrame:
    """For each document with entities that terms disclose: _id, _hash, terms (term, p)."""
    entities = found.select("_id", "_hash", F.inline("found")).select("_id", "_hash", "kind", "value").distinct()
    terms = entities.join(disclosed, ["kind", "value"]).groupBy("_id", "_hash", "term").agg(F.max("p").alias("p"))
    return terms.groupBy("_id", "_hash").agg(F.collect_list(F.struct("term", "p")).alias("terms"))


def _term_spans(text: Column, terms: Column) -> Column:
    """Where a document's disclosing terms stand in its text."""
    pattern = lambda t: F.concat(F.lit(r"(?iu)(?<![\p{L}])"), t.term, F.lit(r"(?![\p{L}])"))
    at = lambda t: F.transform(_located(text, pattern(t)), lambda m: F.struct(m.start.alias("start"), m.end.alias("end"), t.p.alias("p")))
    return F.array_distinct(F.flatten(F.transform(terms, at)))


def find(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with base_spans and spans: arrays of struct(start, kind_order, end, kind, p), by start, then kind; p is null for base ones."""
    docs = docs.select(*[F.col(f"`{f.name}`") for f in others(docs, "base_spans", "spans")])
    p = prefix(docs)
    found = mentions(docs, doc_id, text)
    disclosed = scratch(disclosures(docs, found, doc_id, text), "pii-disclosures")
    span = lambda k, i, m, p: F.struct(m.start.alias("start"), F.lit(i).alias("kind_order"), m.end.alias("end"), F.lit(k).alias("kind"), p.cast("double").alias("p"))
    of_kind = lambda i, k: F.transform(F.col(f"{p}{k}"), lambda m: span(k, i, m, F.lit(None)))
    base = F.array_sort(F.concat(*[of_kind(i, k) for i, k in enumerate(KINDS[:4])]))
    out = _based(docs, doc_id, text, p).withColumn("base_spans", base).drop(*[f"{p}{k}" for k in KINDS[:4]])
    if disclosed.isEmpty():
        return out.withColumn("spans", F.col("base_spans")).drop(f"{p}id", f"{p}hash")
    wanted = scratch(_wanted(found, disclosed), "pii-wanted").select(F.col("_id").alias(f"{p}i"), F.col("_hash").alias(f"{p}h"), F.col("terms").alias(f"{p}terms"))
    # Few documents: their terms go to the texts. Many: both meet on the documents' ids.
    if wanted.agg(F.coalesce(F.sum(F.size(f"{p}terms")), F.lit(0))).first()[0] <= BROADCAST_TERMS:
        wanted = F.broadcast(wanted)
    out = out.join(wanted, F.col(f"{p}id").eqNullSafe(F.col(f"{p}i")) & F.col(f"{p}hash").eqNullSafe(F.col(f"{p}h")), "left")
    spans = F.when(F.col(f"{p}terms").isNotNull(), _term_spans(F.coalesce(F.col(text), F.lit("")), F.col(f"{p}terms")))
    out = out.withColumn(f"{p}terms", spans)
    more = F.transform(F.coalesce(f"{p}terms", F.array().cast("array<struct<start: int, end: int, p: double>>")), lambda m: span("term", 4, m, m.p))
    return out.withColumn("spans", F.array_sort(F.concat("base_spans", more))).drop(*[f"{p}{x}" for x in ("id", "hash", "i", "h", "terms")])


def describe(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))), ",")


def count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s.kind == kind)).cast("bigint")


def _cut(blocks: Column, start: Column, n: Column) -> Column:
    """n code points of a text from start on; blocks: the text in pieces of BLOCK. Only the blocks that the piece is in are read, where a substring of the text counts from the text's beginning."""
    last = F.floor((start + n - 1) / BLOCK).cast("int")
    part = lambda k: F.substring(F.get(blocks, k), F.greatest(start - k * BLOCK, F.lit(0)) + 1, F.least(start + n, (k + 1) * BLOCK) - F.greatest(start, k * BLOCK))
    return F.when(n > 0, F.array_join(F.transform(F.sequence(F.floor(start / BLOCK).cast("int"), last), part), "")).otherwise("")


def sanitise(found: DataFrame, text: str = "text", column: str = "sanitised") -> DataFrame:
    """find()'s result with the text in which spans are replaced by their kind in brackets; terms of at least REMOVE go. Of overlapping spans the first in order counts; the rest of another is dropped."""
    t = F.coalesce(F.col(text), F.lit(""))
    given = F.struct(F.regexp_extract_all(t, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0)).alias("blocks"), F.col("spans").alias("spans"))

    def marked(x: Column) -> Column:
        at = _before(F.transform(x.spans, lambda s: s.end), lambda a, b: F.greatest(a, b))  # where the spans in front of each end

        def piece(s: Column, from_: Column) -> Column:
            mark = F.when((s.kind == "term") & (s.p >= REMOVE), "").otherwise(F.concat(F.lit("["), F.upper(s.kind), F.lit("]")))
            return F.concat(_cut(x.blocks, from_, s.start - from_), F.when(s.start < from_, "").otherwise(mark))

        end = F.aggregate(x.spans, F.lit(0), lambda a, s: F.greatest(a, s.end))
        return F.concat(F.array_join(F.zip_with(x.spans, at, piece), ""), _let(end, lambda e: _cut(x.blocks, e, F.length(t) - e)))

    return found.withColumn(column, F.when(F.size("spans") > 0, _let(given, marked)).otherwise(t))

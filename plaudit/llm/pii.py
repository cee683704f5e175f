"""Personal data: fixed patterns, and terms that disclose protected entities.

Base spans (email, ip, card, phone) are found by regular expressions over whole
texts. The method then adds the terms that give an entity away by the company
they keep (C-sanitisation, Sanchez and Batet, 2016): every base value is a
protected entity ``e`` with information content ``IC(e) = -log P(e)``; a term
``t`` anywhere in a document that mentions ``e`` discloses
``PMI(t; e) = log(P(t, e) / (P(t) P(e)))`` of it. A term is a word of any length or,
in scripts written without spaces, a pair of neighbouring letters. Probabilities are
shares of all documents, counted over whole texts. A term is generalised where
``PMI >= alpha * IC`` and removed where ``PMI = IC``, that is where it never stands in a
document without that entity, at every place in the documents that mention the
entity. Terms need documents with two different surroundings of the mention as
evidence, so copies of one passage count once; entities without them are left out first.

DataFrame operations only. Positions come from two passes of one pattern: the
matches, and the gaps left by splitting at them. Patterns are possessive where
that changes no match, so long runs neither recurse nor backtrack.

Null texts count as empty and have no spans; very long texts are searched whole;
empty tables give empty results; repeated rows get the same spans each; the query
carries no other columns, and :func:`sanitise` passes them through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plaudit.llm.common import cut, small, store

# Kinds in the order in which equal starts are listed; the method's own comes last.
KINDS = ("email", "ip", "card", "phone", "term")
_LOCAL = "[A-Za-z0-9._%+-]"
# Leftmost matches of the base patterns. A run that fails at its start fails at
# each later start, so runs are tried once, at their start or after a match.
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # Only runs of 12 digits and more can hold a card number.
    "card": r"[0-9](?:[\x20-]?+[0-9]){11,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Scripts written without spaces between words, and Hangul, whose names carry particles.
_DENSE = r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsHangul}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}"
TERM = rf"[\p{{L}}&&[^{_DENSE}]]++"
DENSE = rf"[\p{{L}}&&[{_DENSE}]]++"
SPAN = "array<struct<start:int,kind:int,end:int>>"
CONTEXT = 48
ALPHA = 0.8
SUPPORT = 2
# The most texts whose term spans are shipped to every executor.
TEXTS = 20_000


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the check sum of a string of digits is a multiple of ten."""

    def add(total: Column, i: Column) -> Column:
        d = F.substr(digits, F.length(digits) - i, F.lit(1)).cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return total + F.when(i % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), add) % 10 == 0


def _octet(part: Column) -> Column:
    bare = F.regexp_replace(part, "^0+(?=[0-9])", "")
    return (F.length(bare) <= 3) & (F.coalesce(F.when(F.length(bare) <= 3, bare.cast("int")), F.lit(256)) <= 255)


def _valid(kind: str, x: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(x, r"\."), _octet)
    if kind == "card":
        return F.length(_digits(x)).between(12, 19) & _luhn(_digits(x))
    if kind == "phone":
        return F.length(_digits(x)).between(9, 15)
    return F.lit(True)


def _located(text: Column, pattern: str, found: Column, keep, kind: int) -> Column:
    """``(start, kind, end)`` of the matches ``found`` that ``keep`` accepts."""
    gaps = F.split(text, pattern, -1)

    def step(acc: Column, i: Column) -> Column:
        match = F.element_at(found, i)
        start = acc["at"] + F.length(F.element_at(gaps, i))
        end = start + F.length(match)
        span = F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"))
        spans = F.when(keep(match), F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"])
        return F.struct(end.alias("at"), spans.alias("spans"))

    zero = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("spans"))
    steps = F.aggregate(F.sequence(F.lit(1), F.size(found)), zero, step)["spans"]
    return F.when(F.size(found) > 0, steps).otherwise(F.array().cast(SPAN))


def with_base_spans(docs: DataFrame, text: str = "text", out: str = "base") -> DataFrame:
    """Add ``out``: all base spans of the text, by start and kind."""
    body = F.coalesce(F.col(text), F.lit(""))
    needs = {"email": F.contains(body, F.lit("@")), "phone": F.contains(body, F.lit("+"))}
    parts = []
    for i, (kind, pattern) in enumerate(PATTERNS.items()):
        name = f"__found_{kind}"
        found = F.regexp_extract_all(body, F.lit(pattern), F.lit(0))
        if kind in needs:
            found = F.when(needs[kind], found).otherwise(F.array().cast("array<string>"))
        docs = docs.withColumn(name, found)
        parts.append(_located(body, pattern, F.col(name), lambda x, k=kind: _valid(k, x), i))
    docs = docs.withColumn(out, F.array_sort(F.concat(*parts)))
    return docs.drop(*[f"__found_{k}" for k in PATTERNS])


def _hash(term: Column) -> Column:
    return F.xxhash64(F.lower(term))


def _pairs(length: Column) -> Column:
    """Where the pairs of a run begin, from 0; a single letter stands alone."""
    return F.sequence(F.lit(0), F.greatest(length - 2, F.lit(0)))


def _terms(text: Column) -> Column:
    """Hashes of the distinct terms of a text."""
    words = F.transform(F.regexp_extract_all(text, F.lit(TERM), F.lit(0)), _hash)
    runs = F.regexp_extract_all(text, F.lit(DENSE), F.lit(0))
    pairs = F.transform(
        runs, lambda r: F.transform(_pairs(F.length(r)), lambda i: _hash(F.substr(r, i + 1, F.lit(2))))
    )
    return F.array_distinct(F.concat(words, F.flatten(pairs)))


def _blanked(body: Column, spans: Column) -> Column:
    """The text with spaces in place of ``spans``; all other positions stay."""

    def step(acc: Column, s: Column) -> Column:
        low = F.greatest(s["start"], acc["at"])
        out = F.concat(acc["out"], F.substr(body, acc["at"] + 1, low - acc["at"]), F.repeat(F.lit(" "), s["end"] - low))
        return F.when(s["end"] > acc["at"], F.struct(s["end"].alias("at"), out.alias("out"))).otherwise(acc)

    done = F.aggregate(spans, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step)
    return F.concat(done["out"], F.substr(body, done["at"] + 1, F.length(body)))


def _occurrences(text: Column, pattern: str, keep) -> Column:
    """Spans of the matches that ``keep`` accepts, in one walk over the text."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    parts = F.zip_with(F.split(text, pattern, -1), found, lambda g, m: F.struct(g.alias("gap"), m.alias("match")))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["gap"])
        end = start + F.length(x["match"])
        span = F.struct(start.alias("start"), F.lit(len(KINDS) - 1).alias("kind"), end.alias("end"))
        spans = F.when(keep(x["match"]), F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"])
        return F.when(x["match"].isNull(), acc).otherwise(F.struct(end.alias("at"), spans.alias("spans")))

    return F.aggregate(parts, F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("spans")), step)["spans"]


def _occurrences_of(text: Column, terms: Column) -> Column:
    """Spans of all occurrences of the hashed ``terms``."""

    def pairs_of(run: Column) -> Column:
        def pair(i: Column) -> Column:
            start = run["start"] + i
            end = F.least(start + 2, run["end"])
            return F.struct(start.alias("start"), F.lit(len(KINDS) - 1).alias("kind"), end.alias("end"))

        every = F.transform(_pairs(run["end"] - run["start"]), pair)
        return F.filter(every, lambda s: F.array_contains(terms, _hash_at(text, s)))

    words = _occurrences(text, TERM, lambda w: F.array_contains(terms, _hash(w)))
    runs = _occurrences(
        text, DENSE,
        lambda r: F.exists(_pairs(F.length(r)), lambda i: F.array_contains(terms, _hash(F.substr(r, i + 1, F.lit(2))))),
    )
    return F.array_sort(F.concat(words, F.flatten(F.transform(runs, pairs_of))))


def _hash_at(text: Column, s: Column) -> Column:
    return _hash(F.substr(text, s["start"] + 1, s["end"] - s["start"]))


def _mention(text: Column, span: Column) -> Column:
    """The entity of a base span and a hash of ``CONTEXT`` characters around it."""
    low = F.greatest(span["start"] - CONTEXT, F.lit(0))
    before = F.substr(text, low + 1, span["start"] - low)
    after = F.substr(text, span["end"] + 1, F.lit(CONTEXT))
    entity = F.xxhash64(F.lower(F.substr(text, span["start"] + 1, span["end"] - span["start"])), span["kind"])
    return F.struct(entity.alias("entity"), F.xxhash64(before, after).alias("place"))


def _entity_rows(found: DataFrame, support: int = SUPPORT) -> DataFrame:
    """``(uid, key's body, mentions, terms)`` of the documents that mention an entity with
    enough surroundings; a document has one surrounding for each entity."""
    seen = found.where(F.size("base") > 0).select("uid", F.explode("mentions").alias("m")).select("uid", "m.*")
    seen = cut(seen.groupBy("uid", "entity").agg(F.min("place").alias("place")))
    kept = seen.groupBy("entity").agg(F.count(F.lit(1)).alias("n_entity"), F.countDistinct("place").alias("places"))
    kept = cut(kept.where(F.col("places") >= support).drop("places"))
    seen = seen.join(small(kept, kept.count()), "entity")
    per = seen.groupBy("uid").agg(F.collect_list(F.struct("entity", "place", "n_entity")).alias("mentions"))
    return store(found.drop("base", "mentions").join(per, "uid"), "entity_rows")


def _pairs_in(rows: DataFrame, *also: str) -> DataFrame:
    """One row for each entity and term of a document."""
    each = rows.select(*also, "terms", F.explode("mentions").alias("m"))
    return each.select(*also, "m.*", F.explode("terms").alias("term"))


def disclosures(rows: DataFrame, docs: DataFrame, n_docs: int, text: str = "text",
                alpha: float = ALPHA, support: int = SUPPORT) -> DataFrame:
    """``(term, entity, removed)`` of the terms that disclose an entity.

    ``rows`` are those of :func:`_entity_rows`; the terms' document counts come from
    all of ``docs``, aggregated per term before they are shuffled.
    """
    pairs = _pairs_in(rows).groupBy("term", "entity").agg(
        F.count(F.lit(1)).alias("both"),
        F.countDistinct("place").alias("places"),
        F.max("n_entity").alias("n_entity"),
    )
    pairs = store(pairs.where(F.col("places") >= support), "pairs")
    counts = docs.select(F.explode(_terms(F.col(text))).alias("term"))
    counts = counts.groupBy("term").agg(F.count(F.lit(1)).alias("n_term"))
    pairs = pairs.join(counts, "term")
    n = F.lit(float(max(n_docs, 1)))
    content = F.log(n / F.col("n_entity"))
    pmi = F.log(n * F.col("both") / (F.col("n_term") * F.col("n_entity")))
    return cut(
        pairs.where((content > 0) & (pmi >= alpha * content)).select(
            "term", "entity", (F.col("both") >= F.col("n_term")).alias("removed")
        )
    )


def _text_of(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ","
    )


def _scanned(docs: DataFrame, key: str, text: str) -> DataFrame:
    rows = with_base_spans(docs.select(key, text), text)
    body = F.coalesce(F.col(text), F.lit(""))
    some = F.size("base") > 0
    mentions = F.when(some, F.transform("base", lambda s: _mention(body, s)))
    rows = rows.withColumn("mentions", mentions).withColumn("terms", F.when(some, _terms(_blanked(body, F.col("base")))))
    rows = rows.select(
        F.col(key).alias("key"), "base", "mentions", "terms", F.xxhash64(text).alias("body"),
        F.monotonically_increasing_id().alias("uid"),
    )
    return store(rows, "scanned")


def _term_spans(docs: DataFrame, found: DataFrame, key: str, text: str) -> DataFrame:
    """``(__key, __body, terms, gone)`` of the texts with disclosing terms: all their
    occurrences outside base spans, and the starts of those to remove."""
    rows = _entity_rows(found)
    told = disclosures(rows, docs, found.count(), text)
    hits = _pairs_in(rows, "key", "body").join(small(told, told.count()), ["term", "entity"])
    hits = hits.groupBy(F.col("key").alias("__key"), F.col("body").alias("__body")).agg(
        F.collect_set("term").alias("__told"), F.collect_set(F.when(F.col("removed"), F.col("term"))).alias("__removed")
    )
    hits = cut(hits)
    same = F.col(key).eqNullSafe(F.col("__key")) & (F.xxhash64(text) == F.col("__body"))
    texts = docs.select(key, text).join(small(hits, hits.count()), same).dropDuplicates(["__key", "__body"])
    texts = with_base_spans(cut(texts), text, "__base")
    texts = cut(texts.select("__key", "__body", "__told", "__removed", _blanked(F.col(text), F.col("__base")).alias("__blank")))
    texts = texts.withColumn("terms", _occurrences_of(F.col("__blank"), F.col("__told")))
    gone = F.filter("terms", lambda s: F.array_contains(F.col("__removed"), _hash_at(F.col("__blank"), s)))
    return cut(texts.select("__key", "__body", "terms", F.transform(gone, lambda s: s["start"]).alias("gone")))


def personal_spans(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, base, spans)``: arrays of ``(start, kind, end)`` per document."""
    found = _scanned(docs, key, text)
    terms = _term_spans(docs, found, key, text)
    every = F.array_sort(F.concat("base", F.coalesce("terms", F.array().cast(SPAN))))
    same = F.col("key").eqNullSafe(F.col("__key")) & (F.col("body") == F.col("__body"))
    rows = found.select("key", "body", "base").join(small(terms, terms.count(), TEXTS), same, "left")
    return rows.select(F.col("key").alias(key), "base", every.alias("spans"))


def span_report(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts per kind, the digest of the base spans, and all spans as text."""
    spans = personal_spans(docs, key, text)
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [
        (F.size(kinds) - F.size(F.array_remove(kinds, i))).cast("long").alias(f"n_{k}") for i, k in enumerate(PATTERNS)
    ]
    return spans.select(
        key, *counts, F.sha2(_text_of(F.col("base")), 256).alias("base_sha256"), _text_of(F.col("spans")).alias("spans")
    )


def _masked(body: Column, spans: Column, gone: Column) -> Column:
    """The text with each span replaced by its kind in brackets, terms in ``gone``
    by nothing; where spans overlap, the rest of the later one goes too."""
    tags = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])

    def step(acc: Column, s: Column) -> Column:
        low = F.greatest(s["start"], acc["at"])
        tag = F.when(
            (s["start"] >= acc["at"]) & ~((s["kind"] == len(KINDS) - 1) & F.array_contains(gone, s["start"])),
            F.element_at(tags, s["kind"] + 1),
        ).otherwise(F.lit(""))
        out = F.concat(acc["out"], F.substr(body, acc["at"] + 1, low - acc["at"]), tag)
        return F.when(s["end"] > acc["at"], F.struct(s["end"].alias("at"), out.alias("out"))).otherwise(acc)

    done = F.aggregate(spans, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step)
    return F.concat(done["out"], F.substr(body, done["at"] + 1, F.length(body)))


def sanitise(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with all spans masked in ``text``.

    Only texts with base spans meet the table of disclosing terms; the others stay
    as they are, without a shuffle.
    """
    # Named apart from whatever columns the documents have.
    terms = _term_spans(docs, _scanned(docs, key, text), key, text).select(
        "__key", "__body", F.col("terms").alias("__terms"), F.col("gone").alias("__without")
    )
    rows = with_base_spans(docs, text, "__base")
    # Filters on a column that is not deterministic are not moved under the spans,
    # which would search the texts again for every span.
    rows = rows.withColumn("__row", F.monotonically_increasing_id())
    none = F.array().cast(SPAN)
    plain = rows.where((F.size("__base") == 0) & (F.col("__row") >= 0)).select(*docs.columns)
    met = (
        rows.where((F.size("__base") > 0) & (F.col("__row") >= 0))
        .join(small(terms, terms.count(), TEXTS), F.col(key).eqNullSafe(F.col("__key")) & (F.xxhash64(text) == F.col("__body")), "left")
        .withColumn("__spans", F.array_sort(F.concat("__base", F.coalesce("__terms", none))))
        .withColumn("__gone", F.coalesce("__without", F.array().cast("array<int>")))
    )
    new = _masked(F.col(text), F.col("__spans"), F.col("__gone"))
    return plain.union(met.withColumn(text, new).select(*docs.columns))

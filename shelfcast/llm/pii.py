"""Information-theoretic sanitisation of personal data.

Patterns find the protected entities: mail addresses, IP addresses, card and phone numbers.  Terms near an entity can
give it away, so the corpus is asked how much: with documents as the unit of co-occurrence, a term's pointwise
mutual information with an entity, over the entity's own information content, is the share of the entity that the
term discloses.  Of an entity's information no more than ``BITS_KEPT`` bits count, so that a term that leaves the entity
among a given number of documents discloses the same share in a corpus of any size.  How sure the share is depends on the
different contexts in which the two met: the share of the term's documents that hold the entity enters with the lower end
of its confidence interval.  The first meeting is why the pair is looked at, so only the others are evidence, and only
where chance does not explain them: from how often the term is used, the words around the entity and the number of
pairs that met, fewer than ``BY_CHANCE`` pairs of the whole corpus would be expected to meet as often.  Terms that disclose
more than a threshold are generalised to their class, and beyond a higher one removed, at every place of every document,
whether or not it holds the entity.  Entity and term counts come from all documents.

Defined cases: a null text is the empty text; matches that fail their check are dropped without a retry; contexts
count as different only where both sides differ, so copies of one document disclose nothing by themselves, and near
copies with a change on one side of the entity neither; a side without a word takes the whole context's place; an entity that
every document holds has nothing to disclose; words inside an entity are part of it; repeated rows are each returned;
an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import texts, without
from shelfcast.session import materialise

KINDS = ("email", "ip", "card", "phone")
TERM = "term"
NEAR = 10  # words before and after an entity
CERTAIN = 1.645  # standard errors from the measured share to the one that is counted: 95% on one side
GENERALISE, REMOVE = 0.3, 0.5  # share of the entity's information
BITS_KEPT = 10.0  # of an entity's information; who is one of 1,024 has nothing more to lose
BY_CHANCE = 1.0  # pairs in the whole corpus that may be expected to meet as often as a flagged one
FLUSH = 200_000  # terms a task holds before it passes their counts on
BITS = 1 << 24  # of the filter that tells tasks which words may be flagged terms
SALTS = 16  # parts of a flagged term's places

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_WORD = re.compile(r"\w+")

Span = tuple[str, int, int]


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost, non-overlapping; found from the ``@`` outwards, so long runs of letters cost nothing."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (match := _DOMAIN.match(text, at + 1)):
            end = match.end()
            yield start, end
            at = text.find("@", end)
        else:
            at = text.find("@", at + 1)


def luhn(digits: str) -> bool:
    doubled = (2 * int(d) if i % 2 else int(d) for i, d in enumerate(reversed(digits)))
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def _small(part: str) -> bool:
    """Whether a run of digits, however long, is at most 255."""
    digits = part.lstrip("0")
    return len(digits) <= 3 and int(digits or "0") <= 255


def _digits(text: str) -> str:
    return "".join(c for c in text if c in "0123456789")


def base_spans(text: str) -> list[Span]:
    """The entities of a text, by kind, then start; offsets in code points, end exclusive."""
    found: list[Span] = [("email", a, b) for a, b in emails(text)] if "@" in text else []
    if not _DIGIT.search(text):
        return found
    for match in _IP.finditer(text):
        if all(_small(part) for part in match[0].split(".")):
            found.append(("ip", *match.span()))
    for match in _CARD.finditer(text):
        if match.end() - match.start() >= 16:
            digits = _digits(match[0])
            if 16 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", *match.span()))
    if "+" in text:
        for match in _PHONE.finditer(text):
            if 8 <= len(_digits(match[0])) <= 15:
                found.append(("phone", *match.span()))
    return found


def joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def entity_key(kind: str, value: str) -> str:
    """Spellings of one entity are one entity."""
    return f"{kind}:{value.lower() if kind in ('email', 'ip') else _digits(value)}"


def is_term(word: str) -> bool:
    return len(word) > 2 and not word.isdigit()


def covered_words(words: list[tuple[int, int]], spans: list[Span]) -> set[int]:
    """Numbers of the words that are part of an entity."""
    import bisect

    starts = [a for a, _ in words]
    return {
        i
        for _, a, b in spans
        for i in range(max(0, bisect.bisect_right(starts, a) - 1), bisect.bisect_left(starts, b))
        if words[i][1] > a
    }


def mentions(text: str, spans: list[Span], near: int = NEAR) -> list[tuple[str, str, int, int]]:
    """``(entity, term, before, after)`` of the terms near each entity that are not part of one.

    ``before`` and ``after`` are hashes of the words on either side.
    """
    import bisect

    import xxhash

    words = [m.span() for m in _WORD.finditer(text)]
    starts = [a for a, _ in words]
    covered = covered_words(words, spans)
    out = []
    for kind, a, b in spans:
        first, last = bisect.bisect_left(starts, a), bisect.bisect_left(starts, b)
        chosen = [i for i in range(max(0, first - near), min(len(words), last + near)) if i not in covered]
        terms = [text[words[i][0] : words[i][1]].lower() for i in chosen]
        cut = bisect.bisect_left(chosen, first)
        sides = [xxhash.xxh64_intdigest(" ".join(side or terms).encode("utf-8", "replace")) >> 1 for side in (terms[:cut], terms[cut:])]
        entity = entity_key(kind, text[a:b])
        out += [(entity, t, *sides) for t in terms if is_term(t)]
    return out


def scan(docs: DataFrame, near: int = NEAR) -> DataFrame:
    """``doc_id``, ``text_hash``, the counts by kind, ``base`` (spans joined) and ``mentions`` of every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    mention = "struct<entity:string,term:string,before:bigint,after:bigint>"
    schema = (
        f"doc_id {kind}, text_hash bigint, "
        + ", ".join(f"n_{k} bigint" for k in KINDS)
        + f", base string, base_sha256 string, mentions array<{mention}>"
    )

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        names = ("entity", "term", "before", "after")
        form = pa.list_(pa.struct(list(zip(names, [pa.string()] * 2 + [pa.int64()] * 2, strict=True))))
        for batch in batches:
            rows = batch.column(1).to_pylist()
            spans = [base_spans(text) for text in rows]
            base = [joined(s) for s in spans]
            near_by = [
                [dict(zip(names, m, strict=True)) for m in mentions(t, s, near)]
                if s
                else []
                for t, s in zip(rows, spans, strict=True)
            ]
            counts = [pa.array([sum(x[0] == k for x in s) for s in spans], pa.int64()) for k in KINDS]
            digests = [hashlib.sha256(b.encode()).hexdigest() for b in base]
            columns = [batch.column(0), batch.column(2), *counts, pa.array(base, pa.string())]
            columns += [pa.array(digests, pa.string()), pa.array(near_by, form)]
            heads = ["doc_id", "text_hash", *(f"n_{k}" for k in KINDS), "base", "base_sha256", "mentions"]
            yield pa.RecordBatch.from_arrays(columns, heads)

    return texts(docs).withColumn("text_hash", F.xxhash64("text")).mapInArrow(run, schema)


def term_counts(docs: DataFrame) -> DataFrame:
    """``term``, ``n`` (documents that hold it) and ``uses``; the empty term has the uses of all words.

    A task passes on sums, at most ``FLUSH`` terms at a time.
    """

    def run(batches: Iterator) -> Iterator:
        from collections import Counter

        import pyarrow as pa

        def made(held, uses):
            columns = [pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())]
            columns.append(pa.array([uses[t] for t in held], pa.int64()))
            return pa.RecordBatch.from_arrays(columns, ["term", "n", "uses"])

        held: Counter = Counter()
        uses: Counter = Counter()
        words = 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                used = _WORD.findall(text.lower())
                words += len(used)
                uses.update(used)
                held.update(filter(is_term, set(used)))
                if len(uses) > FLUSH:
                    yield made(held, uses)
                    held, uses = Counter(), Counter()
        yield made(held, uses)
        yield made({"": 0}, {"": words})

    return texts(docs).select("text").mapInArrow(run, "term string, n bigint, uses bigint")


def chance(met: Column, expected: Column) -> Column:
    """Upper bound of the probability of ``met`` or more meetings where ``expected`` come by chance (Poisson)."""
    # Stirling's bound of the factorial; the terms after the first fall at least geometrically.
    first = met - expected - met * F.log(met / expected) - 0.5 * F.log(2 * math.pi * met)
    bound = F.exp(first) / (1 - expected / (met + 1))
    return F.when(met <= expected, 1.0).otherwise(F.least(F.lit(1.0), bound))


def disclosures(
    docs: DataFrame,
    found: DataFrame,
    certain: float = CERTAIN,
    least: float = GENERALISE,
    near: int = NEAR,
) -> DataFrame:
    """``entity``, ``term`` and ``share`` of the pairs whose term discloses at least ``least`` of the entity."""
    total = found.count()
    each = found.select(F.explode("mentions").alias("m")).select("m.*")
    apart = materialise(each.distinct())
    differ = F.least(F.count_distinct("before"), F.count_distinct("after"))
    met = materialise(apart.groupBy("entity", "term").agg(differ.alias("contexts")))
    tried = met.count()
    met = met.filter("contexts > 1")  # others have no evidence, and a share of nothing
    around = apart.select("entity", "before", "after").distinct().groupBy("entity").agg(differ.alias("windows"))
    pairs = found.select(F.explode(F.array_distinct(F.transform("mentions", lambda m: F.struct(m["entity"], m["term"])))).alias("m"))
    pairs = pairs.select(F.col("m").getField("entity").alias("entity"), F.col("m").getField("term").alias("term"))
    together = pairs.join(met.select("entity", "term"), ["entity", "term"], "left_semi").groupBy("entity", "term")
    together = together.agg(F.count(F.lit(1)).alias("n_both")).join(met, ["entity", "term"])
    entities = found.select(F.explode(F.array_distinct(F.transform("mentions", lambda m: m["entity"]))).alias("entity"))
    entities = entities.groupBy("entity").agg(F.count(F.lit(1)).alias("n_entity"))
    whole = docs.sparkSession.createDataFrame([("",)], "term string")
    candidates = materialise(met.select("term").distinct().union(whole))
    terms = term_counts(docs).join(candidates, "term", "left_semi").groupBy("term")
    terms = materialise(terms.agg(F.sum("n").alias("n_term"), F.sum("uses").alias("uses")))
    words = terms.filter("term = ''").agg(F.max("uses")).first()[0] or 1
    own = F.least(F.log2(F.lit(total) / F.col("n_entity")), F.lit(BITS_KEPT))
    # Wilson's lower bound, copies counted once: as many trials as give the meetings after the first.
    rate = F.least(F.lit(1.0), F.col("n_both") / F.col("n_term"))
    more, square = F.col("contexts") - 1, certain * certain
    trials = more / rate
    spread = certain * F.sqrt(rate * (1 - rate) / trials + square / (4 * trials * trials))
    sure = (rate + square / (2 * trials) - spread) / (1 + square / trials)
    share = F.when(own > 0, (own + F.log2(sure)) / own).otherwise(0.0)
    expected = (F.col("windows") - 1) * (1 - F.exp(F.col("uses") * F.lit(-2.0 * near / words)))
    scored = together.join(entities, "entity").join(around, "entity").join(terms, "term").withColumn("share", share)
    return scored.filter((F.col("share") >= least) & (chance(more, expected) * tried <= BY_CHANCE)).select("entity", "term", "share")


def term_places(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """``doc_id``, ``text_hash``, ``term``, ``share`` and ``places`` of the ``terms`` in all of every text.

    ``terms`` has ``term`` and ``share``.  Tasks pass on the words that a bitmap of fixed size lets through, which are
    all of the terms and few others; the terms themselves then meet them by a join in which each has ``SALTS`` parts.
    """
    import numpy as np

    bit = F.pmod(F.crc32("term"), F.lit(BITS))
    cells = terms.select(F.expr("term"), bit.alias("bit")).select(
        F.floor(F.col("bit") / 8).cast("int").alias("cell"), F.expr("shiftleft(1, cast(bit % 8 as int))").alias("mask")
    )
    cells = cells.groupBy("cell").agg(F.bit_or("mask").alias("mask")).toArrow()
    table = np.zeros(BITS // 8, np.uint8)
    table[cells["cell"].to_numpy()] = cells["mask"].to_numpy()
    shared = docs.sparkSession.sparkContext.broadcast(table.tobytes())
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator) -> Iterator:
        import zlib

        import pyarrow as pa

        bitmap = shared.value

        def may_be(word: str) -> bool:
            term = word.lower()
            at = zlib.crc32(term.encode("utf-8", "replace")) % BITS
            return bool(bitmap[at >> 3] >> (at & 7) & 1) and is_term(term)

        passed: set[str] = set()
        others: set[str] = set()
        for batch in batches:
            rows, terms_, places = [], [], []
            for row, text in enumerate(batch.column(1).to_pylist()):
                held = set(_WORD.findall(text))
                for word in held - passed - others:
                    (passed if may_be(word) else others).add(word)
                held &= passed
                if len(passed) + len(others) > FLUSH:
                    passed, others = set(), set()
                if not held:
                    continue
                words = [m.span() for m in _WORD.finditer(text)]
                covered = covered_words(words, base_spans(text))
                by_term: dict[str, list[dict]] = {}
                for i, (a, b) in enumerate(words):
                    if text[a:b] in held and i not in covered:
                        by_term.setdefault(text[a:b].lower(), []).append({"start": a, "end": b})
                rows += [row] * len(by_term)
                terms_ += by_term
                places += by_term.values()
            if rows:
                at = pa.array(rows, pa.int64())
                form = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
                columns = [batch.column(0).take(at), batch.column(2).take(at)]
                columns += [pa.array(terms_, pa.string()), pa.array(places, form)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "term", "places"])

    schema = f"doc_id {kind}, text_hash bigint, term string, places array<struct<start:int,end:int>>"
    held = texts(docs).withColumn("text_hash", F.xxhash64("text")).mapInArrow(run, schema)
    held = held.withColumn("salt", F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(SALTS)))
    salts = F.explode(F.array(*(F.lit(i).cast("bigint") for i in range(SALTS))))
    return held.join(terms.withColumn("salt", salts), ["term", "salt"]).drop("salt")


def find_personal_data(
    docs: DataFrame,
    near: int = NEAR,
    certain: float = CERTAIN,
    generalise: float = GENERALISE,
    remove: float = REMOVE,
) -> DataFrame:
    """Counts by kind, ``base_sha256``, ``spans`` (entities, then disclosing terms), ``removed`` for every row.

    ``removed`` joins those of the term spans that are to be removed; the other terms are to be generalised.
    """
    found = materialise(scan(docs, near))
    flagged = disclosures(docs, found, certain, generalise, near).groupBy("term").agg(F.max("share").alias("share"))
    flagged = materialise(flagged)
    hits = term_places(docs, flagged).withColumn("out", F.col("share") >= remove)
    each = F.transform("places", lambda p: F.struct(p["start"], p["end"], F.concat_ws(":", F.lit(TERM), p["start"], p["end"]).alias("span"), "out"))
    # Repeated rows give the same places again.
    extra = hits.groupBy("doc_id", "text_hash").agg(F.array_sort(F.flatten(F.collect_set(each))).alias("extra"))
    extra = materialise(extra.select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"), "extra"))
    on = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("text_hash") == F.col("__hash"))
    listed = F.concat_ws(",", F.transform("extra", lambda x: x["span"]))
    removed = F.concat_ws(",", F.transform(F.filter("extra", lambda x: x["out"]), lambda x: x["span"]))
    spans = F.concat_ws(",", F.nullif("base", F.lit("")), F.nullif(listed, F.lit("")))
    return found.join(extra, on, "left").select(
        "doc_id",
        *(f"n_{k}" for k in KINDS),
        "base_sha256",
        spans.alias("spans"),
        removed.alias("removed"),
        "text_hash",
    )


def replaced(text: str, spans: str, removed: str) -> str:
    """``text`` with entities and generalised terms replaced by their class, and removed terms left out."""
    gone = set(removed.split(","))
    cuts = []
    for span in filter(None, spans.split(",")):
        kind, start, end = span.split(":")
        a, b = int(start), int(end)
        if kind != TERM:
            put = f"<{kind}>"
        elif span in gone:
            put = ""
        else:
            put = "<name>" if text[a].isupper() else "<word>"
        cuts.append((a, b, put))
    out, at = [], 0
    for a, b, put in sorted(cuts):
        if a >= at:
            out += [text[at:a], put]
        at = max(at, b)
    return "".join([*out, text[at:]])


def sanitise(docs: DataFrame, **settings) -> DataFrame:
    """``docs`` with the text of every row sanitised, all columns kept."""
    found = find_personal_data(docs, **settings).filter("spans <> ''")
    found = materialise(found.select("doc_id", "text_hash", "spans", "removed").distinct())
    keyed = docs.withColumn("__hash", F.xxhash64(F.coalesce("text", F.lit(""))))
    keys = found.select("doc_id", F.col("text_hash").alias("__hash"))
    plain = without(keyed, keys).select(*docs.columns)
    renamed = found.select(
        F.col("doc_id").alias("__id"), F.col("text_hash").alias("__h"), F.col("spans").alias("__s"), F.col("removed").alias("__r")
    )
    on = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__hash") == F.col("__h"))
    rows = keyed.join(renamed, on)

    @F.pandas_udf("string")
    def clean(text, spans, removed):
        import pandas as pd

        return pd.Series([replaced(*x) for x in zip(text, spans, removed, strict=True)], dtype=object)

    cleaned = rows.withColumn("text", clean("text", "__s", "__r")).select(*docs.columns)
    return plain.unionByName(cleaned)

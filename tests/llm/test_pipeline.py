"""The pipeline, stage by stage and as a whole, against plain Python."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from test_dedup import brute_components, digest, slow_fingerprint
from test_scans import items_of, slow_leaks
from test_tokens import first_fit
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from shelfcast.llm import catalog
from shelfcast.llm.common import vocabulary_path
from shelfcast.session import materialise

SF_DIR = "/root/testdata/sf0.001"


def test_queries_are_registered():
    names = set(entry.queries())
    assert {q.split("_")[0] for q in catalog.queries()} == {f"op{n}" for n in range(1, 14)}
    assert set(catalog.queries()) | {"pipeline"} <= names


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_equals_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "benchmark", "embeddings"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    want = duck.execute(catalog.oracle_sql()[name])
    columns = [d[0] for d in want.description]
    got = catalog.queries()[name](spark, SF_DIR)
    assert Counter(tuple(r) for r in got.select(*columns).collect()) == Counter(want.fetchall())


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_runs_over_its_whole_table(spark, name):
    found = catalog.queries()[name](spark, SF_DIR)
    keys = {"op7": ("page_id", "pages"), "op11": ("vec_id", "embeddings"), "op13": ("vec_id", "embeddings")}
    whole, source = keys.get(name.split("_")[0], ("doc_id", "documents"))
    ids = {r[0] for r in spark.read.parquet(f"{SF_DIR}/{source}.parquet").select(whole).collect()}
    got = {r[0] for r in found.select(whole).collect()}
    assert got <= ids if name.startswith(("op2", "op3", "op12")) else got == ids


def test_stages_decide(spark, docs, corpus):
    now, rows = docs, {}
    for name, stage in corpus_pipeline.STAGES:
        now = stage(spark, now, SF_DIR)
        rows[name] = now.collect()
        if name != "pack":
            assert now.columns == docs.columns
    left = {r.doc_id for r in rows["language_id"]}
    assert {200, 201, 202, 203} & left == set() and {0, 1, 204, 205, 207} <= left
    left = {r.doc_id for r in rows["exact_dedup"]}
    assert not any(100 <= (i or 0) < 120 for i in left)
    texts = Counter("".join((r.text or "").split()) for r in rows["exact_dedup"])
    assert max(texts.values()) == 1
    assert len(rows["simhash_dedup"]) <= len(rows["exact_dedup"])
    assert {r.doc_id for r in rows["pack"]} == {r.doc_id for r in rows["decontaminate"]}


def whole_corpus() -> list[tuple]:
    """Two languages; near copies and copies of them, leaks whole and changed, leaks only a copy holds, odd texts."""
    pick = random.Random(8)
    north = "the and thing reading waterfall north house with under stone river making".split()
    south = "della ragazza perche mattina quello sempre amore giorno finestra vicino sole strada".split()
    items = [text for _, text in items_of() if text and len(text.split()) > 10]
    rows = []
    for i in range(120):
        words = pick.choices(north if i % 2 else south, k=pick.randint(20, 120))
        if i % 8 == 1:
            item = pick.choice(items).split()
            if i % 16 == 1:
                item[len(item) // 2] = "changed"
            at = pick.randrange(len(words))
            words[at:at] = item
        rows.append((i, " ".join(words), "aa" if i % 2 else "bb"))
    long = " ".join(pick.choices(north, k=5000))
    rows += [(200 + i, rows[i][1].replace(" ", "  ", 3), rows[i][2]) for i in range(10)]  # longer, so these stay
    rows += [(300 + i, rows[40 + i][1], rows[40 + i][2]) for i in range(10)]  # exact copies
    rows += [(400, long, "aa"), (401, long + " end", "aa"), (402, long.replace(" ", "\n", 1), "aa")]
    rows += [(403, "end " + long, None), (404, long + " " + items[0], "aa")]
    return [*rows, (500, None, "aa"), (501, "", "bb"), (502, "12 34 !!", "aa"), (503, "word", "aa"), (504, " \t", None)]


def expected(rows: list[tuple], items: list[tuple]) -> dict[str, set[int]]:
    """Ids that each stage keeps, by plain Python over the rows the stage before it kept."""
    left, out = dict((i, text or "") for i, text, _ in rows), {}
    # With two languages the likelier one has at least half the probability, so only texts without a letter go.
    left = {i: text for i, text in left.items() if any(c.isalpha() for c in text)}
    out["language_id"] = set(left)
    groups = defaultdict(list)
    for i, text in left.items():
        groups[digest(text)].append((-len(text), i))
    left = {i: left[i] for _, i in map(min, groups.values())}
    out["exact_dedup"] = set(left)
    ids = sorted(left)
    label = brute_components([slow_fingerprint(left[i]) for i in ids], 3)
    left = {i: left[i] for i in (min(i for i, x in zip(ids, label, strict=True) if x == one) for one in set(label))}
    out["simhash_dedup"] = set(left)
    leaks = {i for i, _, _ in slow_leaks(list(left.items()), items)}
    out["decontaminate"] = set(left) - leaks
    return out


def test_run_equals_brute_force(spark, tmp_path, monkeypatch):
    rows, items = whole_corpus(), items_of()
    want = expected(rows, items)
    sizes = [len(rows), *(len(want[name]) for name, _ in corpus_pipeline.STAGES[:-1])]
    assert all(a - b >= 3 for a, b in zip(sizes, sizes[1:]))  # every stage has something to decide
    schema = "doc_id bigint, text string, lang string"
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    kept = {}

    def watched(name, stage):
        def run(*given):
            kept[name] = materialise(stage(*given))
            return kept[name]

        return run

    monkeypatch.setattr(corpus_pipeline, "STAGES", [(n, watched(n, f)) for n, f in corpus_pipeline.STAGES])
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    texts = {i: (text, lang) for i, text, lang in rows}
    for name, ids in want.items():
        found = [tuple(r) for r in kept[name].select("doc_id", "text", "lang").collect()]
        assert sorted(found) == sorted((i, *texts[i]) for i in ids), name
    tokenizer = Tokenizer.from_file(vocabulary_path("word_bpe_49k.json"))
    pieces = Counter()
    for i in want["decontaminate"]:
        ids = [*tokenizer.encode(texts[i][0], add_special_tokens=False).ids, 0]
        for piece, start in enumerate(range(0, len(ids), 2048)):
            raw = np.array(ids[start : start + 2048], "<u4").tobytes()
            pieces[(i, piece, start, len(raw) // 4, zlib.crc32(raw))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == pieces
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        places.sort()
        assert [o for o, _ in places] == [sum(n for _, n in places[:i]) for i in range(len(places))]
        assert sum(n for _, n in places) <= 2048
    assert len(sequences) <= first_fit([r.length for r in got], 2048)


def test_run(spark):
    found = corpus_pipeline.run(spark, SF_DIR).collect()
    fill = defaultdict(int)
    for r in found:
        fill[r.sequence_id] += r.length
    assert found and max(fill.values()) <= 2048

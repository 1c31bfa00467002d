"""Corpus pipeline: each stage's decisions on a planted fixture, and the registered query
against the stages run one by one."""

import base64
import random

import public_tokenizers
import pytest
import tiktoken

import __spark_entry__
import corpus_pipeline
from occurlens.llm import decontaminate, ngram_join, quality_rules
from occurlens.llm.queries import BPE_RANKS
from test_ngram_join import brute

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def encoding():
    with open(BPE_RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    """Clean, short, copied, nearly copied, contaminated and personal documents."""
    rng = random.Random(12)
    prose = lambda n: " ".join(f"w{rng.randrange(10 ** 7)}" for _ in range(n))
    item = prose(30)
    original = prose(200)
    near = original.split()
    near[50] = "changed"
    texts = {1: prose(120), 2: "too short", 3: original, 4: original, 5: " ".join(near),
             6: prose(60) + " " + item[:150] + " " + prose(60), 7: prose(80) + " mail a.b@c.example.com now", 8: None, 9: ""}
    rows = [(i, t, "en", "s", len(t or "")) for i, t in texts.items()]
    root = tmp_path_factory.mktemp("sf")
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    return str(root), texts


def test_stages_on_planted_documents(spark, planted):
    root, texts = planted
    docs = spark.read.parquet(f"{root}/documents.parquet")
    left = []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, root)
        if name != "tokens":
            assert out.columns == docs.columns and out.dtypes == docs.dtypes
        docs = corpus_pipeline.written(out, name)
        left.append(sorted(r.doc_id for r in docs.select("doc_id").collect()))
    assert left == [[1, 3, 4, 5, 6, 7], [1, 3, 6, 7], [1, 3, 7], [1, 3, 7], [1, 3, 7]]
    enc = encoding()
    want = {1: texts[1], 3: texts[3], 7: texts[7].replace("a.b@c.example.com", "[EMAIL]")}
    got = {r.doc_id: r for r in docs.collect()}
    for i, text in want.items():
        assert got[i].ids == enc.encode_ordinary(text) and got[i].n_tokens == len(got[i].ids)
    run = {r.doc_id: r.ids for r in __spark_entry__.queries()["pipeline"](spark, root).collect()}
    assert run == {i: r.ids for i, r in got.items()}


def test_empty_documents(spark, planted, tmp_path):
    root, _ = planted
    spark.read.parquet(f"{root}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{root}/benchmark.parquet").limit(0).write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_whole_run_against_brute_force(spark, tmp_path):
    """All stages in plain Python on 60 rows: near copies, repeated rows, a text of 40,000 words, shared benchmark
    windows, e-mail addresses, short and null texts, and extra columns named like the stages' own."""
    rng = random.Random(5)
    word = lambda: f"w{rng.randrange(10 ** 7)}"
    items = [[word() for _ in range(30)] for _ in range(3)]
    texts = {}
    for i in range(20):
        words = [word() for _ in range(rng.randrange(30, 160))]
        texts[3 * i] = words
        texts[3 * i + 1] = [word() if rng.random() < 0.01 * (i % 5) else w for w in words]  # from equal to below the threshold
    texts[2] = [word() for _ in range(40_000)]
    texts[5] = texts[2][:39_000]
    for i in range(4):
        texts[8 + 3 * i] = texts[12][:40] + items[i % 3][i:i + 8 + i] + [word() for _ in range(60)]  # 8 to 11 shared words
    texts[20] = [word() for _ in range(50)] + ["a.b@c.example.com"] + [word() for _ in range(20)]
    rows = [(i, " ".join(t)) for i, t in texts.items()] + [(i, " ".join(texts[i])) for i in (0, 2, 20, 33)] + [(90, None), (91, "")]
    rng.shuffle(rows)
    spark.createDataFrame([(i, t, "en", f"s{i % 3}", len(t or ""), 1, "g", "c", "d", 7) for i, t in rows],
                          SCHEMA + ", row_id int, grp string, content string, doc string, node int").repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(items)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    kept = {(i, t) for i, t in rows if len((t or "").split()) >= 50}
    classes = brute(sorted(kept))
    kept = {(i, t) for i, t in kept if classes[i][0] == i}
    windows = {tuple(t[j:j + 10]) for t in items for j in range(21)}
    shares = lambda w: any(tuple(w[j:j + 10]) in windows for j in range(len(w) - 9))
    enc = encoding()
    want = {i: enc.encode_ordinary(t.replace("a.b@c.example.com", "[EMAIL]")) for i, t in kept if not shares(t.split())}
    assert {8, 11} <= set(want) and not {14, 17} & set(want) and 2 in want and 5 not in want
    got = corpus_pipeline.run(spark, str(tmp_path)).select("doc_id", "ids").collect()
    assert len(got) == len(want) and {r.doc_id: r.ids for r in got} == want


@pytest.mark.parametrize("step", ["quality", "near_duplicates", "decontamination"])
def test_word_steps_work_in_small_slices(spark, monkeypatch, step):
    """What a worker holds at once follows a slice of 1 MB of text, not an Arrow batch."""
    module = {"quality": quality_rules, "near_duplicates": ngram_join, "decontamination": decontaminate}[step]
    docs = spark.createDataFrame([(i, f"word{i} " * 9000, "en", "s", 0) for i in range(50)], SCHEMA)
    items = spark.createDataFrame([(0, "f", 1, 0)], "item_id long, kind string, hash long, size int")
    calls, held, cut = [], [], module.text_slices

    def slices(*args, **options):
        for part in cut(*args, **options):
            held.append(part.num_rows)
            yield part

    def step_of(df, f, schema):
        calls.append((f, df.toArrow()))
        return df

    monkeypatch.setattr(type(docs), "mapInArrow", step_of)
    monkeypatch.setattr(module, "written", lambda df, name: df)
    monkeypatch.setattr(module, "text_slices", slices)
    {"quality": lambda: quality_rules.measure(docs),
     "near_duplicates": lambda: ngram_join.sketch(docs, 5, 24, 5, "text", "doc_id"),
     "decontamination": lambda: decontaminate.scan(docs, items, 10, 5, 12, "text")}[step]()
    (run, table), = calls
    rows = sum(out.num_rows for out in run(iter(table.combine_chunks().to_batches())))
    assert rows == sum(held) == 50 and max(held) <= 20  # of 54 KB each

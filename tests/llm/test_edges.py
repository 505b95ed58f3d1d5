"""Nulls, empty and very long texts, ties, repeated rows, empty tables, clashing extra columns."""

import hashlib
import itertools
import os
import random
import re
import types

import numpy as np
import pyarrow as pa
import pytest

from surveil.llm import bpe, chat, covertree, html, minhash, mixing, paragraphs, quality, suffix, warc
from surveil.session import stage

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
EXTRA = ", size string, kept string, n_bytes int, row int, key int, u int, gone string, copies int, rank int"


def sentence(rng, n):
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9))) for _ in range(n)).capitalize() + "."


def texts():
    """(id, text): every odd case, copies, near copies, shared passages, one long text."""
    rng = random.Random(7)
    long = " ".join(sentence(rng, 9) for _ in range(3000))
    base = [" ".join(sentence(rng, rng.randint(5, 12)) for _ in range(12)) for _ in range(12)]
    shared = " ".join(sentence(rng, 9) for _ in range(8))
    rows = [(0, None), (1, ""), (2, "   \n\t "), (3, "one two"), (4, "One TWO"), (5, long), (6, long), (7, "ünï çödé " * 60), (8, "na " * 400), (None, base[0]), (9, base[0])]
    for i, text in enumerate(base):
        words = text.split()
        near = list(words)
        near[len(near) // 2] = "changed"
        rows += [(10 + 4 * i, text), (11 + 4 * i, text), (12 + 4 * i, " ".join(near)), (13 + 4 * i, text[:200] + " " + shared + " " + text[200:])]
    return [*rows, (11, base[0])]  # an id that repeats


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", f"s{(i or 0) % 3}" if i != 5 else None, len(t or "")) for i, t in texts()]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def clashing(docs):
    from pyspark.sql import functions as F
    names = [x.split()[0] for x in EXTRA.strip(", ").split(", ")]
    return docs.select("*", *[F.lit(None).cast(x.split()[1]).alias(n) for n, x in zip(names, EXTRA.strip(", ").split(", "), strict=True)])


STAGES = [quality.clean, minhash.drop_near_duplicates, suffix.cut_repeats, mixing.mix]


@pytest.mark.parametrize("stage", STAGES, ids=lambda f: f.__module__.rsplit(".", 1)[1])
def test_stage_keeps_columns_and_takes_an_empty_table(stage, empty, clashing):
    assert stage(empty).collect() == [] and stage(empty).columns == empty.columns
    out = stage(clashing)
    assert out.columns == clashing.columns
    assert out.count() > 0


@pytest.mark.parametrize("operator", [quality.judge, minhash.near_duplicates, suffix.remove_repeats, mixing.allocate, paragraphs.remove_passages],
                         ids=lambda f: f.__module__.rsplit(".", 1)[1])
def test_operator_takes_an_empty_table(operator, empty):
    assert operator(empty).collect() == []


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} - {()}


def roots(nodes, links):
    root = {n: n for n in nodes}
    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_minhash_matches_all_pairs(docs):
    rows = texts()
    sets = [(i, shingles(t)) for i, t in rows]
    links = [(a, b) for (a, x), (b, y) in itertools.combinations(sets, 2)
             if a is not None and b is not None and x and y and 100 * len(x & y) >= 75 * len(x | y)]
    # rows that repeat an id are one document
    expect = roots({i for i, _ in rows if i is not None}, links)
    got = minhash.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    for row in got:
        if row.doc_id is None:
            assert row.component_id is None and row.kept
        else:
            assert (row.component_id, row.kept) == (expect[row.doc_id], expect[row.doc_id] == row.doc_id)
    assert sorted(r.n_shingles for r in got) == sorted(len(s) for _, s in sets)


def test_minhash_lists_a_pair_of_several_buckets_once(spark):
    """Near copies share many buckets: the last join makes a row per pair, and loses none."""
    keys = {1: [10, 20, 30], 2: [10, 20, 30], 3: [20, 30, 40], 4: [40, 50], 5: [50, 10, 30]}
    rows = [(k, d, d, 9, *[7] * minhash.LONGS, [5] * (2 * minhash.FINE // 16)) for d, own in keys.items() for k in own]
    schema = "key long, doc long, component long, n_shingles long, " + "".join(f"bit{i} long, " for i in range(minhash.LONGS)) + "fine array<long>"
    found = minhash.open_pairs(spark.createDataFrame(rows, schema)).collect()
    assert sorted(map(tuple, found)) == [(a, b) for a, b in itertools.combinations(keys, 2) if set(keys[a]) & set(keys[b])]


def test_minhash_meets_a_partner_in_a_bucket_of_two(spark):
    """A document near a smaller one that is no link, and linked with one it meets in buckets of two only."""
    rng = random.Random(31)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(7))
    rows = []
    for i in range(60):
        words = [word() for _ in range(200)]
        far, linked = list(words), list(words)
        far[:46] = [word() for _ in range(46)]
        linked[-22:] = [word() for _ in range(22)]
        rows += [(3 * i, " ".join(far)), (3 * i + 1, " ".join(linked)), (3 * i + 2, " ".join(words))]
    sets = [(i, shingles(t)) for i, t in rows]
    links = [(a, b) for (a, x), (b, y) in itertools.combinations(sets, 2) if 100 * len(x & y) >= 75 * len(x | y)]
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(links) == 60 and got == roots(set(got), links)


def test_finer_values_keep_links(spark):
    """Pairs at the threshold pass; nearly all pairs a tenth below it do not."""
    rng = random.Random(32)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(7))
    rows = []
    for i in range(40):
        words = [word() for _ in range(304)]
        for side, changed in enumerate((0, 42, 64)):
            rows.append((3 * i + side, " ".join([*words[changed:], *[word() for _ in range(changed)]])))
    got = {r.doc: r.fine for r in minhash.finer(spark.createDataFrame([*rows, (120, " "), (121, None)], "doc_id long, text string")).collect()}
    frame = spark.createDataFrame([(3 * i + s, got[3 * i], got[3 * i + s]) for i in range(40) for s in (1, 2)], "doc long, fine_a array<long>, fine_b array<long>")
    passed = {r.doc for r in frame.filter(minhash.close()).collect()}
    assert len(got) == 120 and {3 * i + 1 for i in range(40)} <= passed and len(passed) <= 45


def brute_repeats(rows):
    """(kept text, spans) per row: 100-byte strings that start earlier by (id, start) go."""
    first = {}
    key = lambda i: suffix.LAST_ID if i is None else i
    raw = [(key(i), (t or "").encode()) for i, t in rows]
    for i, b in raw:
        for p in range(len(b) - 99):
            w = b[p:p + 100]
            first[w] = min(first.get(w, (i, p)), (i, p))
    out = []
    for i, b in raw:
        gone = bytearray(len(b))
        for p in range(len(b) - 99):
            if first[b[p:p + 100]] < (i, p):
                gone[p:p + 100] = b"\1" * 100
        spans = sum(1 for p in range(len(b)) if gone[p] and not (p and gone[p - 1]))
        out.append((len(b), sum(gone), spans, hashlib.sha256(bytes(c for c, g in zip(b, gone, strict=True) if not g)).hexdigest()))
    return out


def test_suffix_matches_brute_force(docs):
    got = sorted((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix.remove_repeats(docs).collect())
    assert got == sorted(brute_repeats(texts()))


def test_suffix_leaves_one_table_beside_the_texts(spark, docs, monkeypatch):
    """When texts are joined, phrases, dictionary and marks are gone from the shared folder."""
    left = {}
    monkeypatch.setattr(suffix, "stage", lambda frame, name, *codec: left.setdefault(name, stage(frame, name, *codec)))
    suffix.repeats(docs).count()
    assert {name for name, table in left.items() if os.path.exists(table.staged_in)} == {"gone"}


def test_suffix_splits_a_key_with_many_phrases(spark, monkeypatch):
    rng = random.Random(3)
    line = "this line of boilerplate stands in every single document of the whole corpus, as they sometimes do, again and again. "
    rows = [(i, sentence(rng, 20) + line[:110 - i % 7] + sentence(rng, 20)) for i in range(60)]
    monkeypatch.setattr(suffix, "PHRASES_PER_BUCKET", 4)
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sorted((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix.remove_repeats(frame).collect())
    assert got == sorted(brute_repeats(rows))


def test_cover_sort_against_plain_sort():
    rng = np.random.default_rng(5)
    parts = [bytes(rng.integers(97, 99, int(rng.integers(100, 170))).astype(np.uint8)) for _ in range(20)]
    parts += [parts[0], parts[1][:110], parts[2][5:]] + [b"ab" * 70]
    sizes = np.array([len(p) for p in parts])
    stop = np.cumsum(sizes)
    start = stop - sizes
    text = np.frombuffer(b"".join(parts), np.uint8)
    ranks = suffix.cover_ranks(text, np.arange(len(text)), np.repeat(stop, sizes))
    owner = np.repeat(np.arange(len(parts)), sizes)
    suffixes = [parts[o][i - start[o]:] for i, o in enumerate(owner)]
    assert [suffixes[i] for i in np.lexsort([[len(s) for s in suffixes], ranks[:len(text)]])] == sorted(suffixes)


def test_cover_has_every_distance():
    assert {(a - b) % suffix.PERIOD for a in suffix.COVER for b in suffix.COVER} == set(range(suffix.PERIOD))


def test_quality_rules(spark):
    rows = [(0, None), (1, ""), (2, "Home | About | Contact | Help\n" * 9), (3, "A clean line with enough words stands here. " * 1 + "Another one follows it at once, and it is long enough too.\nClick here!\nThat was all."),
            (4, "word " * 30), (5, "LOUD!! NOISE!! IN!! EVERY!! WORD!! " * 5), (6, "alpha*** beta&&& gamma### delta%%% epsilon$$$ zeta. " * 5 + sentence(random.Random(1), 30))]
    got = {r.doc_id: r for r in quality.judge(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[i].kept for i in range(7)] == [False, False, False, True, False, False, False]
    assert got[0].n_words == 0 and got[0].base_failed and got[2].n_dup_lines == 8 and got[3].n_failed_lines == 1
    cleaned = quality.clean(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert [r.doc_id for r in cleaned] == [3] and "Click" not in cleaned[0].text


def test_quality_takes_a_batch_in_pieces(spark, monkeypatch):
    """Rows of one batch of Spark's are measured a few at a time, with their other columns."""
    sizes, own = [], quality.measure
    rows = [(i, sentence(random.Random(i), 60) * 40 if i % 7 else None) for i in range(200)]
    schema = spark.createDataFrame(rows, "doc_id long, text string").select("text", "doc_id").schema
    batch = pa.RecordBatch.from_pydict({"text": [t for _, t in rows], "doc_id": [i for i, _ in rows]})
    monkeypatch.setattr(quality, "measure", lambda texts: sizes.append(sum(len(t or "") for t in texts)) or own(texts))
    frame = types.SimpleNamespace(columns=["doc_id", "text"], select=lambda *_: types.SimpleNamespace(
        mapInArrow=lambda run, _: list(run([batch])), schema=schema))
    out = pa.Table.from_batches(quality.judge(frame)).to_pydict()
    assert len(sizes) > 2 and max(sizes) <= 1 << 20
    assert out["doc_id"] == [i for i, _ in rows] and out["n_words"] == own([t for _, t in rows])[0][0].tolist()


def test_quality_keeps_labelled_documents(spark):
    folder = "/root/testdata/sf0.01"
    judged = quality.query(spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id")
    good = judged.filter("quality = 1 AND NOT base_failed")
    assert good.filter("NOT kept").count() == 0
    bad = judged.filter("quality = 0")
    assert bad.filter("kept").count() <= 0.1 * bad.count()


def test_mixing_targets_and_takes(docs):
    rows = mixing.allocate(docs, ["source"]).collect()
    words = sum(r["size"] for r in rows)
    by = {}
    for r in rows:
        by.setdefault(r.source, []).append(r)
        assert r.taken <= 2 * r["size"]
    assert abs(sum(v[0].target for v in by.values()) - 1.5 * words) < 1e-6 * words
    for v in by.values():
        assert v[0].target <= 2 * v[0].source_size
        assert abs(sum(r.taken for r in v) - v[0].target) <= 2 * max(r["size"] for r in v)
    assert mixing.mix(docs).count() == sum(r.copies for r in rows)
    assert sorted(map(str, rows)) == sorted(map(str, mixing.allocate(docs.repartition(7), ["source"]).collect()))


def test_bpe_matches_the_library(spark, docs):
    from tokenizers import Tokenizer
    path = bpe.vocabulary_path()
    library = Tokenizer.from_file(path)
    library.no_truncation()
    library.no_padding()
    odd = ["<|startoftext|>x<|endoftext|>", "ΑΣ ΣΑΣ İI ﬁ Å é x", "don't WE'LL ''ss 12½", "aaaa aaaaaaa abababab", "a\x1cb\x85c\xa0d e", "😀👩‍👧 mañana", "漢字かな 한국어 العربية"]
    rng = random.Random(2)
    odd += ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(0x80, 0x600), rng.randrange(0x1E00, 0x2100), rng.randrange(0x3000, 0x3200), 9, 10, 32, 32])) for _ in range(60)) for _ in range(200)]
    frame = spark.createDataFrame(list(enumerate([*odd, None, ""])), "doc_id long, text string")
    for frame in (frame, docs):
        out = bpe.decode(bpe.encode(frame.withColumn("_t", frame.text), path), path).collect()
        for row in out:
            ids = library.encode(row._t or "", add_special_tokens=False).ids
            assert row.ids == ids and row.n_tokens == len(ids)
            text = library.decode(ids, skip_special_tokens=False)
            assert row.decoded == text and row.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
            assert row.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
    assert bpe.encode(frame.limit(0), path).collect() == []


def test_pipeline_stages_give_back_heap(spark):
    """Stages that follow a shuffle or load a model have executors collect garbage first (local: in the driver's JVM)."""
    import corpus_pipeline
    beans = spark._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans()
    collected = lambda: sum(beans[i].getCollectionCount() for i in range(beans.size()) if "Young" not in beans[i].getName())
    docs = spark.createDataFrame([(1, "a", "some words")], "doc_id long, source string, text string")
    for step in (corpus_pipeline.mix, corpus_pipeline.tokenize):
        before = collected()
        step(spark, docs, "")
        assert collected() > before


def test_bpe_rests_between_tasks():
    """A worker that goes on to other work keeps the model, not the pieces of its last task."""
    model = bpe.PairIndexBpe(open(bpe.vocabulary_path(), encoding="utf-8").read())
    before = model.encode_all(["some words, and more of them"])[0].tolist()
    model.rest()
    assert len(model.pieces_known.number) == len(model.special) and not model.words.number
    assert model.encode_all(["some words, and more of them"])[0].tolist() == before


def test_pipeline_tokenizes_in_one_worker_a_task(spark, monkeypatch):
    """Encoding and decoding share a Python worker; the digests are those of the ids that are written."""
    import corpus_pipeline
    frame = spark.createDataFrame([(1, "s", "Some words, ünï 12"), (2, "s", None), (3, "t", "<|endoftext|> aaa" * 9)], "doc_id long, source string, text string")
    found = corpus_pipeline.tokenize(spark, frame, "")
    assert found._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    assert found.columns == ["doc_id", "source", "ids", "n_tokens", "ids_sha256", "decoded_sha256"]
    apart = bpe.digests(bpe.encode(frame, bpe.vocabulary_path(), digest=False), bpe.vocabulary_path(), keep_ids=True)
    monkeypatch.setattr(bpe, "DECODED_IDS", 5)
    assert sorted(map(str, corpus_pipeline.tokenize(spark, frame, "").collect())) == sorted(map(str, found.collect())) == sorted(map(str, apart.select(found.columns).collect()))


def test_ids_are_written_and_decoded(spark, tmp_path, monkeypatch):
    """The pipeline's last table has the ids; op9's digests come from ids that went through decode."""
    from tokenizers import Tokenizer

    import corpus_pipeline
    path = bpe.vocabulary_path()
    library = Tokenizer.from_file(path)
    rows = [(1, "s", "Some words, ünï <|endoftext|> 12"), (2, "s", None), (3, "t", "")]
    ids = {i: library.encode(t or "", add_special_tokens=False).ids for i, _, t in rows}
    frame = spark.createDataFrame(rows, "doc_id long, source string, text string")
    assert {r.doc_id: r.ids for r in corpus_pipeline.tokenize(spark, frame, "").collect()} == ids
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    expect = {(i, len(x), sha(" ".join(map(str, x))), sha(library.decode(x, skip_special_tokens=False))) for i, x in ids.items()}
    out = bpe.query(spark, str(tmp_path))
    assert {tuple(r) for r in out.collect()} == expect and out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    decode = bpe.decode
    monkeypatch.setattr(bpe, "decode", lambda *a: decode(*a).withColumn("decoded", F_lit("other")))
    assert {r.decoded_sha256 for r in bpe.query(spark, str(tmp_path)).collect()} == {sha("other")}


def F_lit(value):
    from pyspark.sql import functions as F
    return F.lit(value)


def test_chat_round_trip_and_branches(spark):
    rows = [(1, 1, None, "user", "hi # <b> \\h", 0.0), (1, 2, 1, "assistant", "a\n</turn>", 1.0), (1, 3, 1, "assistant", None, 9.0), (1, 4, 3, None, "deep: ### x: y", 9.0),
            (1, 4, 3, None, "deep: ### x: y", 9.0), (2, 1, 7, "a:ss", "orphan", None), (2, 2, 2, "user", "self", None), (2, 5, 6, "x", "cycle", 0.0), (2, 6, 5, "x", "cycle", 0.0)]
    rows += [(3, i, i - 1 if i else None, "assistant" if i % 2 else "user", f"turn {i}", 0.0) for i in range(70)]
    frame = spark.createDataFrame(rows, "tree long, node long, parent long, role string, text string, score double").repartition(3)
    out = chat.format_trees(frame)
    got = {(r.tree, r.leaf): r for r in out.select("tree", "leaf", chat.read_back(out.formatted).alias("turns"), chat.masked_text(out.formatted, out.mask).alias("learned"), "score").collect()}
    assert set(got) == {(1, 2), (1, 4), (2, 1), (2, 2), (3, 69)}
    assert [tuple(t) for t in got[1, 4].turns] == [("user", "hi # <b> \\h"), ("assistant", ""), ("", "deep: ### x: y")]
    assert got[1, 2].learned == "a\n</turn>" and got[1, 4].learned == "" and [tuple(t) for t in got[2, 1].turns] == [("a:ss", "orphan")]
    assert [t[1] for t in got[3, 69].turns] == [f"turn {i}" for i in range(70)]
    assert got[3, 69].learned == "".join(f"turn {i}" for i in range(1, 70, 2))
    assert {(r.tree, r.leaf) for r in chat.format_trees(frame, top=1).collect()} == {(1, 4), (2, 1), (3, 69)}
    assert chat.format_trees(frame.limit(0)).collect() == []


def test_warc_seeks_and_revisits(spark):
    rows = [(5, "http://a/", "same"), (3, None, "same"), (9, "http://b/\r\nX: y", None), (4, "u", ""), (7, "v", "é" * 300_000), (3, "again", "same"), (None, "w", "same"), (8, "z", "solo \r\n\r\n WARC/1.1")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2)
    folder = warc.new_folder(spark)
    index = warc.write_archives(frame, folder)
    got = warc.read_records(index, folder).collect()
    kinds = sorted(((r.page_id or -1), r.record_type, r.refers_to, r.payload_bytes) for r in got)
    assert kinds == sorted([(5, "revisit", 3, 4), (3, "response", None, 4), (3, "response", None, 4), (-1, "revisit", 3, 4), (9, "revisit", 4, 0), (4, "response", None, 0), (7, "response", None, 600_000), (8, "response", None, 18)])
    one = warc.read_records(index.filter("page_id = 8"), folder).collect()
    assert [bytes(r.payload) for r in one] == [b"solo \r\n\r\n WARC/1.1"]
    assert warc.read_records(warc.write_archives(frame.limit(0), warc.new_folder(spark)), folder).collect() == []


def test_warc_frames_are_plain_zstandard(spark):
    import io
    import zstandard
    from pyarrow import fs
    rows = [(i, "u", str(i) * 200_000) for i in range(9)]
    folder = warc.new_folder(spark)
    index = warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1), folder).collect()
    assert len({r.frame for r in index}) > 2
    system, path = fs.FileSystem.from_uri(folder)
    whole = system.open_input_file(f"{path}/{index[0].archive}").read()
    plain = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(whole), read_across_frames=True).read()
    assert plain.count(b"WARC/1.1\r\n") == 9


def unit(x):
    return np.asarray(x, float) / np.linalg.norm(x)


def test_embeddings_match_all_pairs(spark, monkeypatch):
    rng = np.random.default_rng(1)
    vectors = [list(map(float, rng.normal(size=8).astype(np.float32))) for _ in range(150)]
    for k in range(40):
        vectors.append([float(np.float32(x + 0.15 * rng.normal())) for x in vectors[0]])
    vectors += [vectors[3], vectors[3], [2 * x for x in vectors[3]], [1e-30] + [0.0] * 7, [1e30] + [0.0] * 7]
    bad = [None, [], [0.0] * 8, [None] + [1.0] * 7, [float("nan")] + [1.0] * 7, [float("inf")] + [1.0] * 7]
    rows = list(enumerate([*vectors, *bad, [1.0, 2.0]]))
    monkeypatch.setattr(covertree, "BLOCK", 40)
    monkeypatch.setattr(covertree, "PIVOTS", 3)
    frame = spark.createDataFrame([*rows, (None, vectors[3])], "vec_id long, embedding array<float>").repartition(3)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in covertree.links(frame).collect()}
    units = {i: unit(v) for i, v in enumerate(vectors)}
    links = [(a, b) for a, b in itertools.combinations(units, 2) if units[a] @ units[b] >= 0.95]
    root = roots(range(len(rows)), links)
    count = {i: sum(i in x for x in links) for i in range(len(rows))}
    assert {i: got[i] for i in range(len(rows))} == {i: (count[i], root[i], root[i] == i) for i in range(len(rows))}
    assert got[None] == (0, None, True)
    assert covertree.links(frame.limit(0)).collect() == []


def test_cover_tree_levels():
    rng = np.random.default_rng(2)
    x = covertree.unit(np.concatenate([rng.normal(size=(60, 5)), np.repeat(rng.normal(size=(3, 5)), 20, 0) + 0.01 * rng.normal(size=(60, 5))]).astype(np.float32))
    order, nodes, radii = covertree.build(x)
    y = x[order]
    for (center, lo, hi, first, end), radius in zip(nodes, radii, strict=True):
        assert covertree.distances(y[[center]], y[lo:hi]).max() <= radius + covertree.MARGIN
        if end > first:  # children split their parent's members
            assert nodes[first, 1] == lo and nodes[end - 1, 2] == hi and (nodes[first + 1:end, 1] == nodes[first:end - 1, 2]).all()


HTML = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body><nav><li>Menu</nav>
<header><h1>Site</h1></header><!-- ad --><div class="ad">Buy</div><article><h1>Head &amp;amp; shoulders</h1><p><b>First
 para<br><p>Second &lt;x&gt; 1 < 2<ul><li>one<li>two</ul><aside>side</aside><div id="comments"><p>troll</div><form>f</form></article><footer>&copy;</footer></body>"""


def test_html_article(spark):
    rows = [(1, "http://h/a", HTML), (2, None, None), (3, "x", ""), (4, "http://h/b", "plain text only"), (1, "http://h/a", HTML), (5, "http://h/c", "<p>" + "long " * 100_000)]
    got = html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    by = {r.page_id: r.text for r in got}
    assert len(got) == 6
    assert by[1] == "Head &amp; shoulders\nFirst para\nSecond <x> 1 < 2\none\ntwo"
    assert by[2] == by[3] == "" and by[4] == "plain text only" and len(by[5]) == 499_999
    assert html.extract(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def test_html_template_of_a_host(spark):
    """Subtrees on many pages of a host go; the same subtree on few pages of another host stays."""
    page = "<body><div><p>All our services at a glance</p></div><div><p>Story number {}</p></div></body>"
    rows = [(i, f"https://User@Big.example:80/{i}", page.format(i)) for i in range(12)] + [(20 + i, f"http://small.example/{i}", page.format(i)) for i in range(3)]
    got = {r.page_id: r.text for r in html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[4] == "Story number 4" and got[21] == "All our services at a glance\nStory number 1"


def test_html_template_is_a_share_of_different_pages(spark):
    """Copies of a page are one page; a small host has template; few of many pages do not make one."""
    page = "<body><div><p>Menu of {}</p></div><div><p>Story number {}</p></div>{}</body>"
    rows = [(i, f"http://copies/{i}", page.format("copies", 1, "")) for i in range(10)]
    rows += [(100 + i, f"http://nine/{i}", page.format("nine", i, "")) for i in range(9)]
    rows += [(200 + i, f"http://large/{i}", page.format(i, i, "<p>Shared words</p>" if i < 12 else "")) for i in range(60)]
    got = {r.page_id: r.text for r in html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[3] == "Menu of copies\nStory number 1" and got[104] == "Story number 4"
    assert got[205] == "Menu of 5\nStory number 5\nShared words"


def test_html_template_inside_articles(spark):
    """A box that recurs inside articles goes; a shared paragraph, a box of one page and a whole article stay."""
    page = "<body><div>{0}</div><article><h1>Title {0}</h1><p>Shared by all.</p><div class='body'><p>Story {0}</p></div><div><p>Get our letter</p><ul><li>By post</ul></div></article></body>"
    rows = [(i, f"http://site/{i}", page.format(i)) for i in range(8)]
    rows += [(20 + i, f"http://few/{i}", page.format(i)) for i in range(3)]
    rows += [(40 + i, f"http://same/{i}", f"<body><p>{i}</p><main><div><p>One story</p></div></main></body>") for i in range(8)]
    got = {r.page_id: r.text for r in html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert [got[i] for i in range(8)] == [f"Title {i}\nShared by all.\nStory {i}" for i in range(8)]
    assert got[21] == "Title 1\nShared by all.\nStory 1\nGet our letter\nBy post"
    assert all(got[40 + i] == "One story" for i in range(8))


def test_paragraphs_remove_later_copies(spark, docs):
    rows = texts()
    got = {(r.doc_id, r.n_bytes): r for r in paragraphs.remove_passages(docs).collect()}
    size = {i: len((t or "").encode()) for i, t in rows}
    # near copies lose much, first copies and short texts nothing
    for i in range(12):
        assert got[10 + 4 * i, size[10 + 4 * i]].n_removed == 0 or i == 0
        assert got[12 + 4 * i, size[12 + 4 * i]].n_removed > 0.3 * size[12 + 4 * i]
    for i in (0, 1, 2, 3, 5, 7, 8):
        assert got[i, size[i]].n_removed == 0
    assert got[6, size[6]].n_removed > 0.9 * size[6]
    assert got[17, size[17]].n_removed > 300  # the pasted passage
    out = paragraphs.remove_passages(docs, with_text=True)
    assert all(hashlib.sha256(r.text.encode()).hexdigest() == r.kept_sha256 for r in out.collect())


def test_every_sentence_starts_a_paragraph(spark):
    """One copied passage of two sentences among other sentences goes, whatever stands around it."""
    rng = random.Random(11)
    passages = [sentence(rng, 11) + " " + sentence(rng, 12) for _ in range(40)]
    rows = [(100 * r + i, " ".join([sentence(rng, 12) for _ in range(4)] + [p] + [sentence(rng, 12) for _ in range(4)])) for r in range(2) for i, p in enumerate(passages)]
    got = {r.doc_id: r.n_removed for r in paragraphs.remove_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[i] == 0 and got[100 + i] >= len(p) for i, p in enumerate(passages))


def test_long_sentences_are_cut_by_content(spark):
    """A passage inside long lines without full stops is found at any distance from the line's start."""
    rng = random.Random(12)
    words = lambda n: sentence(rng, n)[:-1].lower()
    passages = [words(150) for _ in range(12)]
    rows = [(100 * r + i, f"{words(60 + 7 * i * r + 3 * r)} {p} {words(60)}") for r in range(2) for i, p in enumerate(passages)]
    got = {r.doc_id: r.n_removed for r in paragraphs.remove_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[i] == 0 and got[100 + i] > 0.5 * len(p) for i, p in enumerate(passages))


def same_id_rows():
    """(id, text): two rows without id and a repeated id whose texts differ; all share a passage with an earlier row."""
    rng = random.Random(21)
    passage = " ".join(sentence(rng, 10) for _ in range(4))
    own = [[sentence(rng, 9) for _ in range(12 + 3 * k)] for k in range(5)]
    rows = [(1, passage)] + [(i, "\n".join([*t[:2 * k], passage, *t[2 * k:]])) for k, (i, t) in enumerate(zip([None, None, 7, 7], own, strict=False))]
    return passage, [*rows, (None, "\n".join(own[4])), (7, None)]


@pytest.mark.parametrize("remove", [suffix.remove_repeats, paragraphs.remove_passages], ids=["suffix", "paragraphs"])
def test_rows_of_one_id_lose_only_their_own_repeats(spark, remove):
    passage, rows = same_id_rows()
    out = remove(spark.createDataFrame([(i, t, n) for n, (i, t) in enumerate(rows)], "doc_id long, text string, n int").repartition(3), with_text=True)
    got = {r.n: r.text for r in out.collect()}
    assert len(got) == len(rows) and got[0] == passage and got[5] == rows[5][1] and got[6] == ""
    for n in range(1, 5):
        expect = "".join(rows[n][1].replace(passage, "").split())
        # strings of bytes may go on into the letters around the passage
        assert passage not in got[n] and len(expect) - 4 * (remove is suffix.remove_repeats) <= len("".join(got[n].split())) <= len(expect)
    if remove is suffix.remove_repeats:
        assert sorted((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in out.collect()) == sorted(brute_repeats(rows))


def test_paragraphs_of_one_text_stay_there(spark, monkeypatch):
    """Overlapping paragraphs share values with each other; only those that share one with another text leave their text."""
    rng = random.Random(31)
    rows = [(i, " ".join(sentence(rng, 4) for _ in range(30))) for i in range(20)]
    passage = " ".join(sentence(rng, 10) for _ in range(3))
    rows += [(100, passage), (101, rows[3][1] + " " + passage)]
    counts, keep = {}, paragraphs.stage

    def counting(frame, name, *rest):
        out = keep(frame, name, *rest)
        counts[name] = out.count()
        return out

    monkeypatch.setattr(paragraphs, "stage", counting)
    gone = {r.doc: r.gone for r in paragraphs.removals(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert set(gone) == {101} and sum(b - a for a, b in paragraphs.merged(gone[101])) > 0.95 * len(rows[-1][1])
    assert counts["classes"] <= 60    # of more than 500, which shared buckets with their neighbours


def test_shared_values_are_packed(spark):
    """Values that two texts hold are found through packed rows, of which a common value has two a batch, not one per text."""
    rng = random.Random(33)
    common = " ".join(sentence(rng, 10) for _ in range(4))
    rows = [(i, f"{common} " + " ".join(sentence(rng, 10) for _ in range(3))) for i in range(60)] + [(99, " ".join(sentence(rng, 10) for _ in range(6)))]
    docs = spark.createDataFrame([(i, t) for i, t in rows], "row long, text string").coalesce(1)
    got = [(r.row, r.key) for r in paragraphs.shared_values(docs.unionByName(docs.limit(5)).repartition(2)).collect()]
    holders = {}
    for i, t in rows:
        for key in paragraphs.paragraphs([t.encode()])[4].ravel().tolist():
            holders.setdefault(key, set()).add(i)
    assert set(got) == {(i, key) for key, own in holders.items() if len(own) > 1 for i in own}
    packed = paragraphs.parse(docs, 4).collect()
    entries = [k for r in packed if not r.passed for k in np.frombuffer(r["keys"], np.uint64).tolist()]
    assert max(entries.count(k) for k in set(entries)) <= 2 and {k for k in entries} == set(holders)


def test_crowded_buckets_are_divided(spark):
    """A bucket of unlike classes does not make all its pairs, and loses none that is near the threshold."""
    rng = random.Random(34)
    texts = [[f"w{rng.randrange(10 ** 6)}" for _ in range(30)] for _ in range(150)]
    texts += [[*t[:29], "other"] for t in texts[:20]]     # Jaccard 25 / 27
    offsets, hashes = minhash.shingle_sets([" ".join(t).encode() for t in texts])
    bits = list(minhash.extracts(minhash.signatures(offsets, hashes)))
    sketch = spark.createDataFrame([(i, i, 26, *map(int, b)) for i, b in enumerate(bits)], "doc long, text long, n_shingles long, " + ", ".join(f"bit{i} long" for i in range(len(bits[0]))))
    rows = sketch.selectExpr("1L AS key", "doc", "doc AS component", "text", "n_shingles", *[f"bit{i}" for i in range(paragraphs.EARLY)])
    parts = paragraphs.divisions(rows, sketch)
    assert parts.groupBy("key").count().selectExpr("sum(count * (count - 1) / 2)").first()[0] < 2000     # of 36 times 14,365
    assert sorted(map(tuple, paragraphs.open_pairs(parts, sketch).collect())) == [(i, 150 + i) for i in range(20)]


def test_links_inside_texts_by_brute_force():
    """Components inside texts hold no pair that is not linked, and miss no pair that is well above the threshold."""
    rng = random.Random(32)
    texts = []
    for _ in range(6):
        parts = [sentence(rng, 24) for _ in range(8)]
        near = [" ".join([*p.split()[:-1], "other."]) for p in parts]
        texts.append(" ".join([*parts, *near, *[sentence(rng, 3) for _ in range(20)]]).encode())
    owner, _, _, name, values, first, stop, shingle = paragraphs.paragraphs(texts)
    label = paragraphs.linked_inside(owner, name, values, first, stop, shingle)
    sets = [set(shingle[a:b].tolist()) for a, b in zip(first, stop, strict=True)]
    parent = list(range(len(sets)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(len(sets)), 2):
        common = len(sets[i] & sets[j])
        if owner[i] == owner[j] and 4 * common >= 3 * len(sets[i] | sets[j]):
            parent[root(i)] = root(j)
            assert label[i] == label[j] or 100 * common < 90 * len(sets[i] | sets[j])
    assert len({*label.tolist()}) < len(sets)
    assert all(root(i) == root(j) for i, j in itertools.combinations(range(len(sets)), 2) if label[i] == label[j])


def test_paragraph_bands_reach_their_recall():
    bands, rows = paragraphs.tune()
    assert 1 - (1 - paragraphs.THRESHOLD ** rows) ** bands >= 1 - paragraphs.MISSED


def test_long_passages_are_caught(spark):
    """Every run of 60 words that an earlier document holds too is touched, on the small table."""
    import duckdb
    folder = "/root/testdata/sf0.01"
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{folder}/documents.parquet' ORDER BY doc_id").fetchall()
    got = {r.doc_id: r.n_removed for r in paragraphs.query(spark, folder).collect()}
    seen, missed, hit = {}, [], 0
    for i, text in rows:
        words = (text or "").split()
        own = {hash(tuple(words[k:k + 60])) for k in range(len(words) - 59)}
        if any(h in seen for h in own):
            hit += 1
            if not got[i]:
                missed.append(i)
        elif got[i]:
            assert shared_words(text, rows[:[r[0] for r in rows].index(i)])
        for h in own:
            seen.setdefault(h, i)
    assert hit > 20 and len(missed) <= 0.02 * hit, missed


def shared_words(text, earlier):
    """Whether a document shares some 5-word shingles with an earlier one."""
    own = shingles(text)
    return any(len(own & shingles(t)) >= 5 for _, t in earlier)


def test_pipeline_matches_brute_force(spark):
    """All five stages on the small table, by plain Python."""
    import duckdb
    from tokenizers import Tokenizer

    import corpus_pipeline
    folder = "/root/testdata/sf0.001"
    rows = duckdb.sql(f"SELECT doc_id, text, source FROM '{folder}/documents.parquet' ORDER BY doc_id").fetchall()
    measured, cleaned = quality.measure([t for _, t, _ in rows])
    rows = [(i, c, s) for (i, _, s), c, k in zip(rows, cleaned, measured[-1], strict=True) if k]
    sets = [(i, shingles(t)) for i, t, _ in rows]
    root = roots([i for i, _ in sets], [(a, b) for (a, x), (b, y) in itertools.combinations(sets, 2) if x and y and 100 * len(x & y) >= 75 * len(x | y)])
    rows = [r for r in rows if root[r[0]] == r[0]]
    seen, left = set(), []
    for i, text, source in rows:
        raw = text.encode()
        gone = bytearray(len(raw))
        for p in range(len(raw) - 99):
            if raw[p:p + 100] in seen:
                gone[p:p + 100] = b"\1" * 100
            seen.add(raw[p:p + 100])
        left.append((i, bytes(c for c, g in zip(raw, gone, strict=True) if not g).decode("utf-8", "ignore"), source))
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t)) for i, t, _ in left}
    per = {}
    for i, _, s in left:
        per[s] = per.get(s, 0) + size[i]
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(sorted(per))}
    capped = set()
    while True:
        rest, free = 1.5 * sum(per.values()) - sum(2 * per[s] for s in capped), sum(w for s, w in weight.items() if s not in capped)
        over = {s for s in per if s not in capped and rest * weight[s] / free > 2 * per[s]}
        if not over:
            break
        capped |= over
    library = Tokenizer.from_file(bpe.vocabulary_path())
    expect = []
    for s in per:
        target = 2.0 * per[s] if s in capped else rest * weight[s] / free
        rate = target / per[s] if per[s] else 0.0
        u = int(hashlib.md5(f"{mixing.SEED}:{s}".encode()).hexdigest()[:8], 16) / 2 ** 32
        for rank, (_, i, t) in enumerate(sorted((size[i], i, t) for i, t, x in left if x == s), 1):
            ids = library.encode(t, add_special_tokens=False).ids
            copies = int(np.floor(rank * rate + u) - np.floor((rank - 1) * rate + u))
            expect += [(i, s, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())] * copies
    got = [(r.doc_id, r.source, r.n_tokens, r.ids_sha256) for r in corpus_pipeline.run(spark, folder).collect()]
    assert sorted(got) == sorted(expect)


# wavelet shards, conversation trie, phrases

def token_ids(text):
    from tokenizers import Tokenizer
    from surveil.llm import wavelet
    model = Tokenizer.from_file(wavelet.vocabulary_path())
    return [*model.encode(text or "", add_special_tokens=False).ids, 0]


ODD_TEXTS = [None, "", " ", "a  b \n\n c\t d\n", "x<|endoftext|>y", "don't  we'll 's", " a b　c", "日本 語　\n text", "a\x1cb c\x85d", "a b\n\n",
             "\n\n", "a\0b c", "12 3½ x² é é", "ﬁ ǅ ß ſ İ", "one two\nthree,four 's"]


def test_wavelet_reads_back_what_the_library_encodes(spark, docs, tmp_path):
    import zlib
    from pyspark.sql import functions as F
    from surveil.llm import wavelet
    rows = [(i, t) for i, t in texts()] + [(1000 + i, t) for i, t in enumerate(ODD_TEXTS)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"start": F.lit("x"), "seq": F.lit(1), "shard": F.lit(None).cast("string")})
    folder = f"file://{tmp_path}/shards"
    index = wavelet.write_shards(frame.repartition(3), folder, wavelet.vocabulary_path(), shard_tokens=5000)
    got = wavelet.read_documents(index, folder).collect()
    encoded = sorted(((i is not None, i or 0, i, token_ids(t)) for i, t in rows), key=lambda r: r[:2])
    assert index.count() > 3 and sorted((r.doc_id is not None, r.doc_id or 0, r.ids) for r in got) == sorted((a, b, ids) for a, b, _, ids in encoded)
    flat = [x for r in sorted(got, key=lambda r: r.start) for x in r.ids]
    assert [r.start for r in sorted(got, key=lambda r: r.start)] == list(itertools.accumulate([0, *(len(r.ids) for r in sorted(got, key=lambda r: r.start))]))[:-1]
    for r in got:
        assert r.ids == flat[r.start:r.start + r.n_tokens] and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
    keys = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert keys == sorted(keys, key=lambda i: (i is not None, i or 0))
    some = [0, 11, 262, 50256, 70000]
    assert {r.token: r.n for r in wavelet.count_tokens(index, folder, some).collect()} == {t: flat.count(t) for t in some}
    found = wavelet.find_token(index, folder, 262).collect()
    assert sorted(r.place for r in found) == [i for i, x in enumerate(flat) if x == 262]
    by_start = {r.start: r for r in got}
    for r in found:
        assert by_start[r.place - r.at].doc_id == r.doc_id
    asked = spark.createDataFrame([(i,) for i in [*range(0, len(flat), 997), len(flat), -1]], "place long")
    assert {r.place: r.token for r in wavelet.tokens_at(index, folder, asked).collect()} == {i: flat[i] for i in range(0, len(flat), 997)}


def test_wavelet_learns_whole_pieces_from_the_model():
    """Pieces the pattern leaves whole go to the library's BPE at once; pieces with other letters are cut by the library."""
    from tokenizers import Tokenizer

    from surveil.llm import wavelet
    spec = open(wavelet.vocabulary_path(), encoding="utf-8").read()
    library, encoder = Tokenizer.from_str(spec), wavelet.CutEncoder(spec)
    plain = ["Some words, don't stop 12½", "naïve café\n\nnext", "“quoted” text… €5", "a"]
    given = []
    encoder.model = types.SimpleNamespace(model=library.model, encode=lambda pieces, **how: given.extend(pieces) or library.encode(pieces, **how))
    assert [x.tolist() for x in encoder.encode(plain)] == [library.encode(t, add_special_tokens=False).ids for t in plain] and not given
    other = ["x 漢字\nabc-def don't", "ёж\n\nb 😀a-b abc-def", "abc-def don't stop"]
    assert [x.tolist() for x in encoder.encode(other)] == [library.encode(t, add_special_tokens=False).ids for t in other]
    assert "漢字" in "".join(given) and not any(p == " stop" for p in given)


def test_wavelet_of_nothing(spark, empty, tmp_path):
    from surveil.llm import wavelet
    folder = f"file://{tmp_path}/shards"
    index = wavelet.write_shards(empty, folder, wavelet.vocabulary_path())
    assert index.collect() == [] and wavelet.read_documents(index, folder).collect() == [] and wavelet.count_tokens(index, folder, [1]).collect() == []


@pytest.mark.parametrize("n", [0, 1, 7, 8, 200, 70_000])
def test_wavelet_file_answers_like_a_list(n):
    import io
    from surveil.llm import wavelet
    rng = np.random.default_rng(n)
    ids = (rng.zipf(1.3, n) % 70_000).astype(np.uint32)
    data = wavelet.PlaneWriter().pack(ids, [5, None], np.array([n // 2, n]))

    class Opened(io.BytesIO):
        def size(self):
            return len(data)

        def read_at(self, count, offset):
            return data[offset:offset + count]
    file = wavelet.WaveletFile(Opened(data))
    assert file.decode().tolist() == ids.tolist() and file.doc_ids == [5, None] and file.ends.tolist() == [n // 2, n]
    for place in rng.integers(0, n, 20).tolist() if n else []:
        assert file.access(place) == ids[place]
    for token in {*ids[:5].tolist(), 1, 69_999, 1 << 20}:
        where = np.flatnonzero(ids == token).tolist()
        assert file.count(token) == len(where) and file.rank(token, n // 3) == sum(p < n // 3 for p in where)
        assert [file.select(token, k) for k in range(len(where))][:50] == where[:50]
        with pytest.raises(IndexError):
            file.select(token, len(where))


def trie_nodes(rows):
    """The nodes of all rebuilt conversations, by their definition."""
    import math
    import zlib
    name = lambda r, x: hashlib.sha256(f"{len(r)}:{r}{x}".encode()).hexdigest()[:32]
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            words = len(re.findall(r"[^\x20\x09-\x0D]+", text))
            convs.setdefault(c, []).append((turn is not None, turn or 0, role, name(role, text), words, text))
    convs = {c: [(t[2], t[5], t[4]) for t in sorted(v)] for c, v in convs.items()}
    members, ended = {(): []}, {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        turns = tuple(convs.get(c - int(math.fmod(c, 20)), [])[:h] + own[h:])
        ended.setdefault(turns, []).append(c)
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    kids = {}
    for p in members:
        if p:
            kids.setdefault(p[:-1], []).append(p)
    below, out = {}, []
    for p in sorted(members, key=len, reverse=True):
        leaves = sum(below[k][0] for k in kids.get(p, [])) or 1
        saved = sum(below[k][1] for k in kids.get(p, [])) + (len(members[p]) - 1) * (p[-1][2] if p else 0)
        below[p] = leaves, saved
        out.append((min(members[p], default=None), len(p), min(members[p[:-1]]) if p else None, len(members[p]), len(kids.get(p, [])), leaves, saved,
                    hashlib.sha256(",".join(map(str, sorted(ended.get(p, [])))).encode()).hexdigest()))
    return sorted(out, key=str)


def conversations(seed):
    rng = random.Random(seed)
    words = ["alpha", "beta gamma", "", None, "delta  epsilon\tzeta"]
    rows = []
    for c in [*range(-45, 130), 1 << 40]:
        first = rng.choice(["hello", "good day"])
        rows += [(c, t, rng.choice(["user", "assistant", None]), first if t == 0 else rng.choice(words)) for t in range(rng.choice([0, 1, 2, 3, 5, 9]))]
    for c in range(200, 400):    # a third of all rows: copies of one conversation
        rows += [(c, t, "user", f"the same {t}") for t in range(5)]
    rows += [(500, None, "user", "no turn"), (500, 1, "user", "x"), (500, 1, "user", "x"), (500, 1, "assistant", "tie"), (None, 0, "user", "nobody")]
    rows += [(600, t, "user", "long " * 50) for t in range(300)]
    return rows


@pytest.mark.parametrize("shard_turns", [1 << 18, 60])
def test_trie_matches_its_definition(spark, monkeypatch, shard_turns):
    from pyspark.sql import functions as F
    from surveil.llm import trie
    monkeypatch.setattr(trie, "SHARD_PATHS", 4)
    monkeypatch.setattr(trie, "RUN_IDS", 16)
    rows = conversations(3)
    frame = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").withColumns({"seq": F.lit(1), "path": F.lit("x"), "name": F.lit(2)})
    got = trie.prefix_trie(trie.branch(trie.sequences(frame)), shard_turns)
    assert sorted(map(tuple, got.collect()), key=str) == trie_nodes(rows)


def test_trie_of_nothing(spark):
    from surveil.llm import trie
    frame = spark.createDataFrame([(None, 0, "user", "x")], "conv_id long, turn int, role string, text string")
    assert list(map(tuple, trie.prefix_trie(trie.branch(trie.sequences(frame))).collect())) == [(None, 0, None, 0, 0, 1, 0, trie.EMPTY)]


def test_ternary_trees_are_balanced():
    from surveil.llm import trie
    tree = trie.TernaryTree()
    for i in trie.median_order(1023):
        tree.insert([i])
    height = {0: 0}
    deepest = [(tree.down[0], 1)]
    for node, level in deepest:
        if node:
            height[node] = level
            deepest += [(tree.low[node], level + 1), (tree.high[node], level + 1)]
    assert max(height.values()) == 10 and sorted(trie.median_order(50)) == list(range(50))


def phrase_rows(docs, least=10, top=2000):
    from collections import Counter
    from fractions import Fraction
    counts, total, out = {}, Counter(), []
    for lang, text in docs:
        f = counts.setdefault(lang or "und", Counter())
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall("[^\x20\x09]+", piece)
            total[lang or "und"] += len(words)
            f.update(tuple(words[i:i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1))
    for lang, f in counts.items():
        cands = {p for p, n in f.items() if len(p) > 1 and n >= least}
        gone = {s for p in cands if len(p) == 3 for s in (p[:2], p[1:]) if 100 * f[p] >= 50 * f[s]}
        scored = []
        for p in cands - gone:
            cut = min((int(Fraction(1_000_000 * f[p] ** 2, f[p[:k]] * f[p[k:]])), k) for k in range(1, len(p)))
            scored.append((-cut[0], -f[p], " ".join(p).encode(), " ".join(p), f[p], f[p[:cut[1]]], f[p[cut[1]:]]))
        for rank, x in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, *x[3:], total[lang], -x[0]))
    return sorted(out)


@pytest.mark.parametrize("batch", [1 << 23, 300])
def test_phrases_match_counting_every_phrase(spark, monkeypatch, batch):
    from pyspark.sql import functions as F
    from surveil.llm import phrases
    monkeypatch.setattr(phrases, "BATCH", batch)
    monkeypatch.setattr(phrases, "ROUNDS", 3)      # long unary paths stay open and are left single
    rng = random.Random(11)
    vocabulary = ["Red", "blue", "GREEN", "ünï", "a\xa0b", "x"]
    licence = " ".join(f"w{i}" for i in range(40))
    rows = [("en", None), (None, ""), ("en", "."), (None, "one two, three"), ("de", "a b a b a b a b a b a b a b a b a b a b a b a b"), ("de", "tab\tbed word\r\nnext")]
    rows += [(rng.choice(["en", "de", None]), " ".join(rng.choice(vocabulary) + rng.choice(["", "", "", ",", "!"]) for _ in range(rng.randint(1, 60)))) for _ in range(80)]
    rows += [("en", licence)] * 15 + [("en", "hot pair " + f"z{i % 40} tail") for i in range(300)] + [("fr", "long " * 4000)]
    frame = spark.createDataFrame(rows, "lang string, text string").withColumns({"node": F.lit(1), "n": F.lit("x"), "next": F.lit(None).cast("int"), "rank": F.lit(0)})
    names = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    got = sorted(map(tuple, phrases.collocations(frame.repartition(4)).select(names).collect()))
    assert got == phrase_rows(rows)
    top = sorted(map(tuple, phrases.collocations(frame, least=2, top=7).select(names).collect()))
    assert top == phrase_rows(rows, 2, 7) and len(top) > 15


def test_phrases_of_nothing(spark, empty):
    from surveil.llm import phrases
    assert phrases.collocations(empty).collect() == []


def test_hot_nodes_are_spread_and_counts_stay(spark, monkeypatch):
    from surveil.llm import phrases
    monkeypatch.setattr(phrases, "SALTS", 5)
    rows = [("en", f"very common word{i % 50} here, very common")  for i in range(600)]
    frame = spark.createDataFrame(rows, "lang string, text string")
    hot = phrases.hot_nodes(frame)
    assert "very common" in hot["en"]
    edges, flows = phrases.heavy_graph(frame)
    assert {r.n for r in flows.filter("node = 'very common'").collect()} == {1200}
    assert sorted(r.n for r in edges.filter("node = 'very common'").collect()) == [12] * 50


def test_paths_are_compacted(spark):
    from surveil.llm import phrases
    frame = spark.createDataFrame([("en", "a b c d e f g h"), ("en", "x c d y")] * 12, "lang string, text string")
    edges, flows = phrases.heavy_graph(frame)
    rows = sorted((r.nodes, r.words, r.counts, r.flows) for r in phrases.paths(edges, flows).collect())
    assert (["d e", "e f", "f g"], ["f", "g", "h"], [12] * 3, [12] * 4) in rows or any(len(r[0]) >= 3 for r in rows)
    assert sum(len(r[1]) for r in rows) == edges.count()

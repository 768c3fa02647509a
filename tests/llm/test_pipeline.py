"""The pipeline against a plain chain of its stages on a small table, and what line dedup leaves of near copies."""

import hashlib

import pytest
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.conftest import SCHEMA, prose
from voxelloom.llm import jaccard_join, line_dedup
from voxelloom.llm.queries import piece_model


def shingles(text):
    w = text.split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def near_groups(texts):
    """The number of the first text of each one's group, by all pairs; texts without words are alone."""
    sets, group = [shingles(t) for t in texts], list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if sets[i] and sets[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) and group[i] != group[j]:
                a, b = sorted((group[i], group[j]))
                group = [a if g == b else g for g in group]
    return group


def sources(rng):
    """Documents of short lines, of which no passage repeats: exact and near copies in one line each, toxic ones, some that hold a test item."""
    items = [(1, "which of these seven rivers runs north to the cold sea of ice"), (2, "name both founders of that old printing house")]
    clean = [prose(rng, 1, 26) for _ in range(40)]
    toxic = [f"you are a {rng.choice(['rotten', 'filthy'])} {rng.choice(['vermin', 'scum'])} and {prose(rng, 1, 9)} get lost vermin scum filth" for _ in range(24)]
    rows = [(i, t) for i, t in enumerate(clean)] + [(100 + i, t) for i, t in enumerate(toxic)]
    rows += [(200 + i, clean[i]) for i in range(3)]  # exact copies: shorter than a window of line dedup
    rows += [(210 + i, clean[5 + i] + " tail") for i in range(3)]  # near copies
    rows += [(220, f"{prose(rng, 1, 6)} {items[0][1]} {prose(rng, 1, 6)}"), (221, items[1][1]), (230, ""), (231, None), (232, " \n ")]
    return rows, items, {100 + i for i in range(24)}


def test_chain(spark, rng, tmp_path):
    rows, items, bad = sources(rng)
    spark.createDataFrame([(d, t, "en", "web", None if t is None else len(t)) for d, t in rows], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    labelled = [(d, 1, int(d in bad)) for d, _ in rows if d < 200]
    spark.createDataFrame(labelled, "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}

    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = {r.doc_id for r in corpus_pipeline.drop_toxic(spark, docs, str(tmp_path)).collect()}
    assert not kept & bad and kept == {d for d, _ in rows} - bad  # the words tell
    left = [(d, t) for d, t in sorted(rows) if d in kept]
    # No passage is as long as line dedup's window, so it changes nothing.
    words = [len((t or "").split()) for _, t in left]
    assert max(words) < line_dedup.WINDOW_WORDS
    group = near_groups([t or "" for _, t in left])
    left = [x for i, x in enumerate(left) if group[i] == i]
    for _, item in items:
        s = shingles(item)
        left = [(d, t) for d, t in left if len(s & shingles(t or "")) < 0.8 * len(s)]
    library = sentencepiece.SentencePieceProcessor(model_file=piece_model())
    want = {d: library.encode(t or "") for d, t in left}
    assert got.keys() == want.keys() and {200, 201, 202, 210, 211, 212, 220, 221}.isdisjoint(got)
    for d, ids in want.items():
        assert got[d].ids == ids and got[d].n_tokens == len(ids) and got[d].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[d].decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_line_dedup_takes_near_copies_first(make, rng):
    """Near copies of long texts are links before line dedup; after it, the later copies have lost the lines they share and are links no more."""
    base = [prose(rng, 30) for _ in range(6)]
    rows = [(10 * i, t) for i, t in enumerate(base)] + [(10 * i + 1, t.replace(t.split()[3], "other", 1)) for i, t in enumerate(base)]
    links = lambda d: jaccard_join.join(d).agg(F.sum("n_links")).first()[0]
    docs = make(rows)
    cleaned = line_dedup.dedup(docs.select("doc_id", "text"))
    assert links(docs) == 12 and links(cleaned) == 0
    assert cleaned.where("removed_words > 200").count() == 6


@pytest.mark.parametrize("dtype", ["<u2", "<u4"])
def test_packed_files_round_trip(spark, make, odd, rng, tmp_path, dtype):
    import collections

    import numpy as np
    import public_tokenizers

    from voxelloom.llm import packing

    rows = [*odd, *((100 + k, prose(rng, rng.randint(1, 60))) for k in range(60))]
    packed = packing.pack(make(rows).repartition(3), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, row_tokens=256, buffer_tokens=5_000, dtype=dtype)
    packed = spark.createDataFrame(packed.collect(), packed.schema).repartition(4)
    path = f"file://{tmp_path}/packed"
    parts = packing.write(packed, path, 256, dtype).collect()
    key = lambda ids, cu, resets: (bytes(ids), tuple(cu), tuple(resets))
    want = collections.Counter(key(r.ids, r.cu_seqlens, r.position_resets) for r in packed.collect())
    got, n = collections.Counter(), 0
    for matrix, cu, resets in packing.read(path):
        assert matrix.dtype == np.dtype(dtype) and matrix.shape[1] == 256 and len(matrix) == len(cu) == len(resets)
        got.update(key(m.tobytes(), c.tolist(), r.tolist()) for m, c, r in zip(matrix, cu, resets, strict=True))
        n += 1
    assert got == want and n == len(parts) > 1 and sum(p.n_rows for p in parts) == packed.count()

"""Token counts and packing against the tokenizer library; mixing against its own definition."""

from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from genoweave.llm import mixing, packing, token_counts
from genoweave.llm.common import common_only

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "", " ", "a", "I'll DON'T we've", "  two  spaces \n\n line\r\n\ttab ", "<|endoftext|> x<|startoftext|>y", "naïve café ½ ² ª", "a\x1cb\x85c d e", "İstanbul ǅ ﬁ Å",
    "日本語 mixed 123 4५६", "é decomposed", "🙂 emoji 👩‍👩‍👧", "x" * 5000, "word " * 3000, "١٢٣ ⅷ", "a​b", "“quoted” – dash… €5", "\x00\x07", "...!!! ??", "end with space ",
]


@pytest.fixture(scope="module")
def texts(spark, sf_dir):
    return ODD + [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect() if r.text is not None]


def test_counts_are_the_librarys(spark, texts):
    rows = [(i, t, 7) for i, t in enumerate([*texts, None])]
    df = token_counts.count_tokens(spark.createDataFrame(rows, "doc_id long, text string, n_bytes int"), BYTE)
    found = {r.doc_id: r.n_tokens for r in df.collect()}
    library = Tokenizer.from_file(BYTE)
    assert found == {i: len(library.encode(t, add_special_tokens=False).ids) if t else 0 for i, t, _ in rows}
    assert df.columns == ["doc_id", "text", "n_bytes", "n_tokens"]


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string, source string")
    assert token_counts.count_tokens(none, BYTE).count() == packing.pack(none, WORD).count() == mixing.copies(none).count() == 0


def test_word_ids_are_the_librarys(texts):
    ids, library = packing.WordIds(WORD), Tokenizer.from_file(WORD)
    for t in texts:
        assert np.frombuffer(ids.ids(t), "<u4").tolist() == library.encode(t, add_special_tokens=False).ids


def test_every_common_character_is_split_as_in_the_library():
    ids, library = packing.WordIds(WORD), Tokenizer.from_file(WORD)
    common = [c for c in map(chr, range(0x3000)) if common_only(c)]
    assert "İ" in common and len(common) > 500
    for t in ["İstanbul", "İSTANBUL.", *(x for c in common for x in (c, f"a{c}b", f"A{c}.", f"{c}{c}A9"))]:
        assert np.frombuffer(ids.ids(t), "<u4").tolist() == library.encode(t, add_special_tokens=False).ids, t


def test_pieces_make_up_documents_and_sequences(spark, texts):
    rows = [(i, t) for i, t in enumerate([*texts, None])] + [(None, "null id"), (0, ""), (5, texts[5])]
    pieces = packing.pack(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), WORD).collect()
    library = Tokenizer.from_file(WORD)
    by_sequence, by_doc = {}, {}
    for p in pieces:
        by_sequence.setdefault(p.sequence_id, []).append(p)
        by_doc.setdefault(p.doc_id, []).append(p)
    for parts in by_sequence.values():
        at = 0
        for p in sorted(parts, key=lambda p: p.offset):
            assert p.offset == at and p.length > 0
            at += p.length
        assert at <= 2048
    for i, t in enumerate(texts):
        if i not in (0, 5):
            ids = np.asarray([*library.encode(t, add_special_tokens=False).ids, 1], "<u4")
            at = 0
            for p in sorted(by_doc[i], key=lambda p: p.start):
                assert p.start == at and p.doc_tokens == len(ids) and p.ids_crc32 == zlib.crc32(ids[at : at + p.length].tobytes())
                at += p.length
            assert at == len(ids)
    assert len(by_doc[0]) == 2 and len(by_doc[None]) == 1 and by_doc[len(texts)][0].doc_tokens == 1


def test_differencing_is_near_equal_and_whole():
    rng = random.Random(5)
    for n, windows in ((1, 1), (3, 5), (40, 1), (300, 17), (1000, 120)):
        sizes = [rng.randint(1, 256) for _ in range(n)]
        dealt = packing.differencing(sizes, windows)
        assert sorted(i for w in dealt for i in w) == list(range(n)) and len(dealt) == windows
        if n >= 8 * windows:
            sums = [sum(sizes[i] for i in w) for w in dealt]
            assert max(sums) - min(sums) <= 8
    for sizes in ([], [2048], [2000, 2000, 100], [1500] * 7):
        dealt = packing.pack_sizes(sizes, 2048)
        assert sorted(i for w in dealt for i in w) == list(range(len(sizes))) and all(sum(sizes[i] for i in w) <= 2048 for w in dealt)
    with pytest.raises(ValueError):
        packing.pack_sizes([3000], 2048)


def test_mix_meets_its_targets(spark):
    rng = random.Random(3)
    rows = [(i, " ".join("w" * rng.randint(1, 60)), s, "x") for i in range(3000) for s in [rng.choice(["a", "b", "b", "b", "c", "d", None])]]
    rows += [(None, None, "a", "x"), (None, "", None, "x"), (7, "same row", "c", "x"), (7, "same row", "c", "x"), (9000, " ", "empty", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, size string")
    found = mixing.copies(docs).collect()
    assert len(found) == len(rows) and sorted(map(str, found)) == sorted(map(str, mixing.copies(docs.repartition(5)).collect()))
    by = {}
    for r in found:
        by.setdefault(r.source, []).append(r)
        assert 0 <= r.copies <= 3
    total = sum(r.size for r in found)
    assert abs(sum(x[0].target for x in by.values()) - total) < 1e-6 * total
    for x in by.values():
        assert sum(r.size for r in x) == x[0].source_size and x[0].target <= 3 * x[0].source_size
        assert abs(sum(r.size * r.copies for r in x) - x[0].target) <= 130
    order = sorted(s for s in by if s is not None) + [None]
    weights = {s: (1, 2, 3)[i % 3] for i, s in enumerate(order)}
    free = {s: by[s][0].target / weights[s] for s in order if by[s][0].target < 3 * by[s][0].source_size}
    assert max(free.values()) - min(free.values()) < 1e-6 * total
    assert all(3 * by[s][0].source_size <= weights[s] * min(free.values()) + 1e-6 for s in order if s not in free)
    assert sorted(map(str, mixing.mix(docs).drop("size").collect())) == sorted(str(r) for r in mixing.copies(docs).selectExpr("explode(array_repeat(struct(doc_id, text, source), int(copies))) r").select("r.*").collect())


def test_a_source_meets_its_target_in_spite_of_large_documents(spark):
    """One document has a third of its source's words: what it brings or lacks, the others make good; reruns agree."""
    rng = random.Random(6)
    rows = [(1000 * k + i, "w " * (9000 if i == 0 else rng.randint(5, 120)), f"s{k}") for k in range(6) for i in range(300)]
    rows += [(90_000 + i, "w " * rng.randint(1, 50), None) for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = mixing.copies(docs).collect()
    assert sorted(map(tuple, found)) == sorted(map(tuple, mixing.copies(docs.repartition(7)).collect()))
    taken, goal = {}, {}
    for r in found:
        assert 0 <= r.copies <= 3
        taken[r.source], goal[r.source] = taken.get(r.source, 0) + r.copies * r.size, r.target
    assert all(abs(taken[f"s{k}"] - goal[f"s{k}"]) <= 0.005 * goal[f"s{k}"] for k in range(6))


def test_the_chance_of_a_document_is_its_sources_rate(spark):
    """Over many alike sources, each with its own offset, documents of all sizes are taken as often as target over size says."""
    sizes = [400] * 2 + [20] * 13 + [1] * 45
    docs = spark.createDataFrame([(100 * k + i, "w " * n, f"s{k:03d}") for k in range(300) for i, n in enumerate(sizes)], "doc_id long, text string, source string")
    share = {}
    for r in mixing.copies(docs).collect():
        share.setdefault((r.size, round(r.target / r.source_size, 6)), []).append(r.copies)
    assert len(share) == 9
    for (size, rate), copies in share.items():
        assert abs(sum(copies) / len(copies) - rate) < 0.08, (size, rate)


def test_columns_of_the_same_names(spark):
    docs = spark.createDataFrame([(1, "two words", "s", "own", 7)], "doc_id long, text string, source string, n_tokens string, size int")
    counted = token_counts.count_tokens(docs, BYTE)
    assert counted.columns == docs.columns and counted.first().n_tokens == 2
    assert mixing.mix(docs).columns == docs.columns and mixing.mix(docs).first()["size"] == 7

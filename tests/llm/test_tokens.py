"""Token files and packing: exact ids, exact round trips, few sequences."""

import io
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from lakeproof.llm.encoding import encoder_of
from lakeproof.llm.packing import cut, pack, plan_runs, plan_table
from lakeproof.llm.tokenfiles import CHUNK_IDS, TokenFileReader, TokenFileWriter, token_file_round_trip
from tests.llm.fixtures import SF_DIR, awkward, documents, prose

PARTS = ["a", "Be", " ", "  ", "\n", "\n\n", "\t", "'s", "'LL", "é", "É", "é", "12", "3", "!", "?!", "\xa0", "中文", "Σ", "İ", "<|endoftext|>", "😀", "\x1c", "\x00", "_", "\r\n", " ", "ß"]


@pytest.mark.parametrize("name, kind", [
    ("word_bpe_49k.json", "word_bpe_49k.json"), ("byte_bpe_50k.json", "byte_bpe_50k.json"), ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken"),
])
def test_ids_equal_the_library(name, kind):
    draw, path = random.Random(1), public_tokenizers.path(name)
    library, ours = Tokenizer.from_file(path), encoder_of(public_tokenizers.path(kind))
    library.encode_special_tokens = True
    texts = ["".join(draw.choice(PARTS) for _ in range(draw.randint(0, 12))) for _ in range(4000)] + [prose(300, 4), prose(300, 4) + "\n\n  x\n"]
    texts += [r.as_py() for r in pq.read_table(f"{SF_DIR}/documents.parquet", columns=["text"])["text"]]
    expected = library.encode_batch(texts, add_special_tokens=False)
    for text, ids, encoding in zip(texts, ours.encode(texts), expected):
        assert np.frombuffer(ids, "<u4").tolist() == encoding.ids, repr(text)


def test_any_range_is_read_back():
    draw = np.random.default_rng(2)
    texts = [draw.integers(0, 49_000, n).astype("<u4") for n in (0, 1, 5, CHUNK_IDS, 3 * CHUNK_IDS + 7, 2)]
    stream = io.BytesIO()
    writer = TokenFileWriter(stream)
    for k, ids in enumerate(texts):
        writer.add(None if k == 2 else k, ids)
    writer.close()
    reader, whole = TokenFileReader(stream, len(stream.getvalue())), np.concatenate(texts)
    assert [(d, at, ids.tolist()) for d, at, ids in reader.documents()] == [
        (None if k == 2 else k, sum(map(len, texts[:k])), ids.tolist()) for k, ids in enumerate(texts)
    ]
    for start, count in ((0, 0), (3, 10), (CHUNK_IDS - 2, 5), (10, len(whole) - 10)):
        assert (reader.read(start, count) == whole[start:start + count]).all()
    assert len(stream.getvalue()) < 0.8 * whole.nbytes


def ids_of(text, name, end):
    library = Tokenizer.from_file(public_tokenizers.path(name))
    return np.array([*library.encode(text or "", add_special_tokens=False).ids, end], "<u4")


def test_files_hold_every_document_in_order(spark):
    rows = awkward() + [(50 - k, prose(20 + k, k)) for k in range(30)]
    found = token_file_round_trip(spark, documents(spark, rows).repartition(5)).collect()
    at, expected = 0, []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = ids_of(text, "word_bpe_49k.json", 1)
        expected.append((str(doc_id), at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert sorted((str(r["doc_id"]), r["start"], r["n_tokens"], r["ids_crc32"]) for r in found) == sorted(expected)
    assert token_file_round_trip(spark, documents(spark, [])).collect() == []


def test_packing_places_every_piece(spark):
    rows = awkward() + [(100 + k, prose(1 + 23 * k, k)) for k in range(60)]
    placed = pack(documents(spark, rows).repartition(4)).collect()
    expected, held = [], defaultdict(list)
    for doc_id, text in rows:
        ids = ids_of(text, "byte_bpe_50k.json", 2)
        expected += [(str(doc_id), k, s, n, zlib.crc32(ids[s:s + n].tobytes())) for k, (s, n) in enumerate(cut(len(ids), 1024))]
    assert sorted((str(r["doc_id"]), r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in placed) == sorted(expected)
    for r in placed:
        held[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in held.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 1024
    least = -(-sum(e[3] for e in expected) // 1024)
    assert len(held) <= 1.05 * least + 1
    assert pack(documents(spark, [])).collect() == []


def test_cuts():
    assert cut(1024, 1024) == [(0, 1024)] and cut(1025, 1024) == [(0, 1), (1, 1024)] and cut(2048, 1024) == [(0, 1024), (1024, 1024)]


def least_bins(lengths, capacity):
    """The fewest bins by trying everything."""
    best = [len(lengths)]

    def put(k, rooms):
        if len(rooms) >= best[0]:
            return
        if k == len(lengths):
            best[0] = len(rooms)
            return
        for i in {r: i for i, r in enumerate(rooms) if r >= lengths[k]}.values():
            put(k + 1, rooms[:i] + [rooms[i] - lengths[k]] + rooms[i + 1:])
        put(k + 1, [*rooms, capacity - lengths[k]])

    put(0, [])
    return best[0]


def test_plans_are_near_the_optimum():
    draw = random.Random(5)
    for _ in range(60):
        lengths = sorted((draw.randint(1, 100) for _ in range(draw.randint(1, 11))), reverse=True)
        runs = plan_runs(Counter(lengths), 100)
        held = Counter()
        for run in runs:
            assert run.room == 100 - sum(n * c for n, c in run.slots) >= 0
            for n, c in run.slots:
                held[n] += c * run.sequences
        assert held == Counter(lengths)
        assert sum(r.sequences for r in runs) <= least_bins(lengths, 100) + 1
        table = plan_table(runs)
        assert sum(r[3] for rows in table.values() for r in rows) >= len(table)


def test_large_plans_waste_less_than_one_percent():
    draw = random.Random(6)
    lengths = Counter(n for _ in range(100_000) for _, n in cut(int(draw.lognormvariate(6, 1.6)) + 1, 1024))
    used = sum(r.sequences for r in plan_runs(lengths))
    assert used <= 1.01 * sum(n * c for n, c in lengths.items()) / 1024

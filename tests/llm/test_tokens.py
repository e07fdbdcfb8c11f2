import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from conftest_llm import PATTERN, RANKS, TOKENIZER, plain_tiktoken, plain_tokenizer, unordered
from rentscope.llm import byte_bpe, packing, subwords, token_codes
from rentscope.llm.subwords import UnitEncoder, slices


def test_units_encode_as_whole_texts(rows):
    plain, units = plain_tokenizer(), UnitEncoder(TOKENIZER)
    texts = [t or "" for _, t, _ in rows]
    texts += [" x", "x ", " ", "  ", "a  b", "a \nb", "a b c", "a 　b", "<|endoftext|> x", "don't 'tis a's b"]
    for _ in range(2):
        for low, high in slices(texts, 5000):
            for text, ids in zip(texts[low:high], units.encode(texts[low:high]), strict=True):
                assert np.frombuffer(ids, "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids


def test_codes_give_any_id():
    rng = random.Random(1)
    ids = np.array([rng.choice([0, 5, 255, 256, 50_000, 70_000, 2**31]) for _ in range(5000)], "<u4")
    counts = np.array([0, 1, 1999, 3000])
    file = token_codes.TokenFile(token_codes.pack([4, None, -1, 9], counts, ids))
    assert file.doc_ids == [4, None, -1, 9]
    assert np.diff(file.starts).tolist() == counts.tolist()
    assert (file.all_ids() == ids).all()
    assert [file[i] for i in range(5000)] == ids.tolist()
    with pytest.raises(IndexError):
        file[5000]


def test_codes_are_read_by_seek(tmp_path):
    rng = random.Random(2)
    ids = np.array([rng.choice([0, 255, 256, 50_000, 70_000, 2**31]) for _ in range(3000)], "<u4")
    path = tmp_path / "codes"
    path.write_bytes(token_codes.pack([1, 2], np.array([1000, 2000]), ids))
    with token_codes.open_there(str(path)) as source:
        file = token_codes.TokenFile(source)
        assert [file[i] for i in range(0, 3000, 7)] == ids[::7].tolist()
        places = np.array(rng.sample(range(3000), 900))
        assert (file.at(places) == ids[places]).all() and len(file.at(places[:0])) == 0


def test_tokens_at(spark, docs, rows, monkeypatch, tmp_path):
    for name, size in (("FILE_IDS", 3000), ("RANGE", 1000), ("SLICE", 5000)):
        monkeypatch.setattr(token_codes, name, size)
    files = token_codes.write_codes(docs, TOKENIZER, 0, token_codes.new_folder(spark, "codes"))
    assert files.count() > 3
    coded = sorted(token_codes.read_codes(files).collect(), key=lambda r: r.start)
    total = coded[-1].start + coded[-1].n_tokens
    wanted = spark.createDataFrame([(p,) for p in [*range(total), total, -1, None, 0]], "place long")
    found = {r.place: r.id for r in token_codes.tokens_at(files, wanted).collect()}
    assert found[total] is None and found[-1] is None and len(found) >= total + 2
    for r in coded:
        ids = np.array([found[p] for p in range(r.start, r.start + r.n_tokens)], "<u4")
        assert zlib.crc32(ids.tobytes()) == r.ids_crc32
    few = token_codes.tokens_at(files, wanted.where("place % 501 = 0 or place is null")).collect()
    assert all(r.id == found[r.place] for r in few if r.place is not None)


def test_codes_of_small_ids_have_one_level():
    file = token_codes.TokenFile(token_codes.pack([1], np.array([3]), np.array([0, 1, 2])))
    assert len(file.levels) == 1 and [file[i] for i in range(3)] == [0, 1, 2]


@pytest.mark.parametrize("file_ids", [200, token_codes.FILE_IDS])
def test_token_codes(spark, docs, rows, monkeypatch, file_ids):
    monkeypatch.setattr(token_codes, "FILE_IDS", file_ids)
    plain = plain_tokenizer()
    found = token_codes.round_trip(spark, docs, TOKENIZER).collect()
    starts, by_start = 0, sorted(found, key=lambda r: r.start)
    for r in by_start:
        assert r.start == starts
        starts += r.n_tokens
    order = [r.doc_id for r in by_start]
    assert order == sorted(order, key=lambda d: (d is not None, d))
    wanted = []
    for doc_id, text, _ in rows:
        ids = np.array([*plain.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        wanted.append((doc_id, len(ids), zlib.crc32(ids.tobytes())))
    assert unordered((r.doc_id, r.n_tokens, r.ids_crc32) for r in found) == unordered(wanted)


def test_token_codes_empty(spark, no_docs):
    assert token_codes.round_trip(spark, no_docs, TOKENIZER).count() == 0


def bpe_expected(rows):
    plain, out = plain_tiktoken(), []
    for doc_id, text, _ in rows:
        ids = plain.encode_ordinary(text or "")
        packed = np.array(ids, "<u4").tobytes()
        decoded = hashlib.sha256((text or "").encode()).hexdigest()
        out.append((doc_id, len(ids), hashlib.sha256(packed).hexdigest(), decoded))
    return unordered(out)


@pytest.mark.parametrize("chunk, overlap", [(byte_bpe.CHUNK, byte_bpe.OVERLAP), (300, 40), (64, 16)])
def test_byte_bpe(docs, rows, chunk, overlap):
    found = byte_bpe.encode(docs, RANKS, PATTERN, chunk, overlap).collect()
    assert unordered(found) == bpe_expected(rows)


@pytest.mark.parametrize("chunk, overlap", [(byte_bpe.CHUNK, byte_bpe.OVERLAP), (300, 40)])
def test_byte_bpe_ids_and_back(docs, rows, chunk, overlap):
    plain = plain_tiktoken()
    pieces = byte_bpe.encode_pieces(docs, RANKS, PATTERN, chunk, overlap)
    by_row = {}
    for r in sorted(pieces.collect(), key=lambda r: (r.alone, r.row, r.run)):
        by_row.setdefault((r.alone, r.row), [r.doc_id, []])[1].extend(np.frombuffer(r.ids, "<u4").tolist())
    wanted = [(i, plain.encode_ordinary(t or "")) for i, t, _ in rows]
    assert unordered(by_row.values()) == unordered(wanted)
    back = byte_bpe.texts(byte_bpe.decode_pieces(pieces, RANKS, PATTERN)).collect()
    assert unordered(back) == unordered((i, t or "") for i, t, _ in rows)


def test_byte_bpe_cuts_anywhere(spark):
    pieces = ["'s", "'", "''", "'re", " ", "  ", "\n", "\n\n ", "ab", "é", "12", "!?", " x", "　", "日本"]
    rows = [(i, "".join(random.Random(i).choices(pieces, k=400)), None) for i in range(60)]
    frame = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    found = byte_bpe.encode(frame, RANKS, PATTERN, 50, 20).collect()
    assert unordered(found) == bpe_expected(rows)


def test_byte_bpe_empty(no_docs):
    assert byte_bpe.encode(no_docs, RANKS, PATTERN).count() == 0


def check_packing(found, rows, capacity):
    plain = plain_tokenizer()
    wanted = []
    for doc_id, text, _ in rows:
        ids = np.array([*plain.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        ends = list(range(len(ids), 0, -capacity))[::-1]
        start = 0
        for piece, end in enumerate(ends):
            wanted.append((doc_id, piece, start, end - start, zlib.crc32(ids[start:end].tobytes())))
            start = end
    assert unordered((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == unordered(wanted)
    sequences = {}
    for r in found:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


@pytest.mark.parametrize("capacity, group", [(1024, 25_000), (100, 7)])
def test_packing(docs, rows, capacity, group):
    found = packing.pack(docs, TOKENIZER, 2, capacity, group).collect()
    used = check_packing(found, rows, capacity)
    total = sum(r.length for r in found)
    assert used <= -(-total // capacity) * 1.25 + 2


def test_sequences_hold_the_ids(docs, rows):
    packed = packing.pack(docs, TOKENIZER, 2, 128, 10, with_ids=True)
    lengths = [(len(r.ids) // 4, r.length) for r in packing.sequences(packed).collect()]
    assert lengths and all(a == b <= 128 for a, b in lengths)


def test_exchange_closes_gaps(spark):
    lengths = random.Random(3).choices(range(150, 700), k=2000)
    items = spark.createDataFrame(list(enumerate(lengths)), "row long, length long")
    placed = packing.place(items, 1024, 50).select("sequence_id").distinct().count()
    alone = packing.best_fit(np.array(lengths), 1024)[2]
    bound = packing.lower_bound(np.array(lengths), 1024)
    assert bound <= len(alone) <= placed <= bound * 1.05 + 2


def fewest_bins(lengths, capacity):
    """The least number of bins, by trying every assignment of a few items."""
    best = len(lengths)

    def place(k, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if k == len(lengths):
            best = len(rooms)
            return
        for b in {room: b for b, room in enumerate(rooms) if room >= lengths[k]}.values():
            place(k + 1, [r - lengths[k] * (i == b) for i, r in enumerate(rooms)])
        place(k + 1, [*rooms, capacity - lengths[k]])

    place(0, [])
    return best


def test_packing_against_the_fewest_bins(spark):
    for seed in range(6):
        lengths = sorted(random.Random(seed).choices(range(5, 70), k=12), reverse=True)
        items = spark.createDataFrame(list(enumerate(lengths)), "row long, length long")
        fewest = fewest_bins(lengths, 100)
        assert packing.lower_bound(np.array(lengths), 100) <= fewest
        used = packing.place(items, 100, 4).select("sequence_id").distinct().count()
        assert fewest <= used <= fewest + 1


def test_rounds_go_on_while_they_save(spark):
    """Small groups leave a bin each that is nearly empty; those meet until no round saves one."""
    items = spark.createDataFrame([(i, 30 + i % 3) for i in range(900)], "row long, length long")
    used = packing.place(items, 100, 4).select("sequence_id").distinct().count()
    assert used <= 305


def test_lower_bound_is_below_any_packing():
    for seed in range(200):
        rng = random.Random(seed)
        lengths = np.array(rng.choices(range(1, 100), k=rng.randint(1, 30)))
        bins, offsets, fills = packing.best_fit(lengths, 100)
        assert max(fills) <= 100 and -(-lengths.sum() // 100) <= packing.lower_bound(lengths, 100) <= len(fills)
    assert packing.lower_bound(np.array([60, 60, 60]), 100) == 3
    assert packing.lower_bound(np.array([34] * 6), 100) == 3
    assert packing.lower_bound(np.zeros(0, int), 100) == 0


def test_packing_empty(no_docs):
    assert packing.pack(no_docs, TOKENIZER, 2).count() == 0


def test_odd_spaces_and_plain_units():
    """The quick tests on strings agree with patterns for every white-space character."""
    white = [chr(c) for c in range(0x110000) if chr(c).isspace()]
    texts = ["", " ", "a b", "a  b", " a", "a ", "é b", "a​b", "a\x00 b"]
    texts += [t for w in white for t in (f"a{w}b", f"a{w} b c", f"é {w}b", f"x y{w}", f"{w}x y", w)]
    for text in texts:
        assert subwords.has_odd_space(text) == bool(re.search(r"^ | $|\s | \s", text)), repr(text)
        assert not subwords.is_plain(text) or re.fullmatch(r"\S+", text), repr(text)

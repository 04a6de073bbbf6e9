"""Archives and id files: what is read back is what went in."""

from __future__ import annotations

import hashlib
import io
import itertools
import zipfile
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from dockhand.llm import idcodec, idfiles, queries, rangecoder, tokens, warc, zipdir
from dockhand.llm.idcodec import BlockError, decode_block, encode_block
from dockhand.llm.queries import FILE_END_ID

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("n", [0, 1, 2, 255, 5000, 70_000])
def test_blocks_round_trip(n):
    rng = np.random.default_rng(n)
    ids = np.minimum(rng.zipf(1.3, n), 50_000).astype(np.uint32)
    block = encode_block(ids)
    assert decode_block(block).tolist() == ids.tolist()
    if n > 5000:
        assert len(block) < 2.5 * n


@pytest.mark.parametrize("at", [5, 30, -1])
def test_damage_is_found(at):
    block = bytearray(encode_block(np.arange(3000, dtype=np.uint32) % 17))
    block[at] ^= 4
    with pytest.raises(BlockError):
        decode_block(bytes(block))


def encoded(texts: list) -> list[list[int]]:
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return [t.encode(x or "", add_special_tokens=False).ids + [FILE_END_ID] for x in texts]


@pytest.mark.parametrize("block_ids", [1 << 20, 50])
def test_id_files(odd_docs, block_ids):
    rows = idfiles.through_id_files(odd_docs, PATH, FILE_END_ID, block_ids=block_ids).collect()
    got = [(r.doc_id, np.frombuffer(bytes(r.ids), "<u4").tolist()) for r in rows]
    docs = odd_docs.collect()
    want = list(zip([d.doc_id for d in docs], encoded([d.text for d in docs])))
    assert sorted(got, key=repr) == sorted(want, key=repr)
    # Gapless in ascending order of the ids, nulls first.
    end = 0
    ordered = sorted(rows, key=lambda r: r.start)
    for r in ordered:
        assert r.start == end and r.n_tokens == len(bytes(r.ids)) // 4
        end += r.n_tokens
    places = [(r.doc_id is not None, r.doc_id or 0) for r in ordered]
    assert places == sorted(places)


def test_id_files_of_an_empty_table(no_docs):
    assert idfiles.through_id_files(no_docs, PATH, FILE_END_ID).count() == 0


@pytest.fixture(scope="module")
def odd_pages(spark):
    big = "<p>same ä</p>" * 20
    rows = [
        (5, "http://a/ b\r\nc", big, 1), (3, None, big, 2), (9, "", big, None), (3, "x", big, 1),
        (None, "http://null", big, 1), (1, "u", "short", 1), (2, "u", "short", 1), (4, "%41", None, 1),
        (6, "u", "", 1), (7, "u", "x" * 100, 1), (8, "u", "x" * 100, 1), (10, "u", "y\r\n\r\nz" * 300_000, 1),
        (11, "u", "z" * 99, 1), (12, "u", "z" * 99, 1),
    ]
    return spark.createDataFrame(rows, "page_id bigint, url string, html string, record_type int")


@pytest.mark.parametrize("archive_bytes", [1 << 26, 300])
def test_archives(odd_pages, archive_bytes):
    rows = warc.through_archives(odd_pages, archive_bytes=archive_bytes).collect()
    pages = odd_pages.collect()
    first: dict[str, int] = {}
    for p in pages:
        if p.page_id is not None and len((p.html or "").encode()) >= 100:
            first[p.html] = min(p.page_id, first.get(p.html, p.page_id))
    want = []
    for p in pages:
        payload = (p.html or "").encode()
        refers = first.get(p.html) if p.page_id != first.get(p.html) else None
        want.append((
            None if p.page_id is None else str(p.page_id), p.url, "revisit" if refers else "response",
            len(payload), hashlib.sha256(payload).hexdigest(), str(refers) if refers else None,
            None if refers else payload,
        ))
    got = [tuple(r[1:7]) + (None if r.payload is None else bytes(r.payload),) for r in rows]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_archives_of_an_empty_table(odd_pages):
    assert warc.through_archives(odd_pages.filter("page_id = 99").coalesce(1)).count() == 0


def test_directory_of_many_members():
    """Over 65,535 members need the ZIP64 records."""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as archive:
        for i in range(66_000):
            archive.writestr(f"m{i}", str(i))
        archive.comment = b"PK\x05\x06 in a comment"
    data = out.getvalue()

    def read(at: int, n: int) -> bytes:
        return data[at:at + n]

    found = zipdir.members(read, len(data))
    assert [m.name for m in found] == [f"m{i}" for i in range(66_000)]
    last = found[-1]
    start = zipdir.data_start(read, last)
    assert last.stored and data[start:start + last.size] == b"65999"


@pytest.mark.parametrize("cut", [1, 30, 200])
def test_a_cut_archive_is_an_error(cut):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as archive:
        archive.writestr("a", "b" * 100)
    data = out.getvalue()[:-cut]
    with pytest.raises(zipdir.ZipError):
        zipdir.members(lambda at, n: data[at:at + n], len(data))


SPECIAL = [
    "a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|startoftext|>y", "<|ENDOFTEXT|> <|EndOfText|>", "<|endoftext",
    "\u00c4 <|endoftext|>\nnext", "\u65e5\u672c <|startoftext|> end", "plain words <| endoftext |>", "tab\t<|endoftext|>", "", None,
]


def test_special_tokens_in_texts_as_the_unchanged_library_gives_them(spark, tmp_path):
    df = spark.createDataFrame(list(enumerate(SPECIAL)), "doc_id bigint, text string")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    for name, query, end in (
        ("byte_bpe_50k.json", queries.op10_token_files, FILE_END_ID),
        ("word_bpe_49k.json", queries.op4_packing, queries.PACKING_END_ID),
    ):
        library = Tokenizer.from_file(queries.tokenizer_path(name))
        want = [library.encode(t or "", add_special_tokens=False).ids + [end] for t in SPECIAL]
        rows = query(spark, str(tmp_path)).collect()
        assert {r.doc_id for r in rows} == set(range(len(SPECIAL)))
        for r in rows:
            ids = np.array(want[r.doc_id], "<u4")
            if "n_tokens" in r:
                assert (r.n_tokens, r.ids_crc32) == (len(ids), zlib.crc32(ids.tobytes()))
            else:
                piece = ids[r.start:r.start + r.length]
                assert (r.doc_tokens, r.ids_crc32) == (len(ids), zlib.crc32(piece.tobytes()))


def test_coded_ids_are_looked_up_in_order(monkeypatch):
    ids = np.random.default_rng(5).integers(0, 5000, 20_000).astype(np.uint32)
    block, search, asked = encode_block(ids), np.searchsorted, []

    def searched(table, values, side):
        asked.append(len(values))
        assert (np.diff(values.astype(np.int64)) >= 0).all()
        return search(table, values, side)

    monkeypatch.setattr(np, "searchsorted", searched)
    assert (decode_block(block) == ids).all()
    assert sum(asked) > 1000


def test_words_are_looked_up_once_known_or_not():
    known = tokens._Known(np.dtype("<u2"))
    known.add(["b", "a"], [b"\x01\x00", b"\x02\x00\x03\x00"])
    places = known.places_of(["a", "c", "b", "a"])
    assert places.tolist() == [1, -1, 0, 1]
    assert known.ids_of(places[[0, 2, 3]], [2, 0, 1]) == [b"\x02\x00\x03\x00\x01\x00", b"", b"\x02\x00\x03\x00"]


def test_each_piece_is_looked_up_once_a_portion(monkeypatch):
    asked, places_of = [], tokens._Known.places_of

    def counted(known, words):
        asked.append(len(words))
        return places_of(known, words)

    monkeypatch.setattr(tokens._Known, "places_of", counted)
    ours = tokens.WordTokenizer(PATH)
    texts = ["the same words, the same words\nagain and again"] * 50
    want = Tokenizer.from_file(PATH).encode(texts[0], add_special_tokens=False).ids
    assert all(np.frombuffer(x, ours.id_type).tolist() == want for x in ours.encode(texts))
    # the, " same", " words", ",", " the", line feed, again, " and", " again"
    assert asked == [9]


def test_more_pieces_than_a_call_takes():
    words = ["é" + "".join(p) for p in itertools.product("abcdefghijklmnopqrstuvwxyz", repeat=3)]
    texts = [" ".join(words[k::3]) for k in range(3)]
    ours = tokens.WordTokenizer(PATH)
    want = Tokenizer.from_file(PATH).encode_batch(texts, add_special_tokens=False)
    assert [np.frombuffer(x, ours.id_type).tolist() for x in ours.encode(texts)] == [e.ids for e in want]
    assert len(ours._known) > 3 * tokens._TOGETHER


def test_pieces_by_kinds_of_bytes():
    text = "a1 é×÷É! «x» 日x \U0001f600. it's ''s\n\n x\ny  zɏɐ"
    cut = tokens._byte_level_cuts(text.encode())
    parts = np.split(np.frombuffer(text.encode(), np.uint8), np.flatnonzero(cut))
    assert [bytes(p).decode() for p in parts] == [
        "a", "1", " é×÷É", "!", " «x»", " 日x", " \U0001f600.", " it", "'s", " ''s", "\n\n x",
        "\n", "y", "  zɏɐ",
    ]


def test_texts_are_encoded_in_portions_by_their_size(monkeypatch):
    monkeypatch.setattr(idfiles, "PORTION_BYTES", 10)
    texts = ["a" * 4, "", "b" * 30, "c", "d" * 3, "e" * 12]
    batch = pa.RecordBatch.from_arrays([pa.array(range(6)), pa.array(texts)], ["id", "text"])
    parts = [p.column(1).to_pylist() for p in idfiles._portions(batch)]
    assert sum(parts, []) == texts
    assert all(sum(map(len, p[1:])) <= 10 for p in parts) and len(parts) > 2


def test_a_lane_moves_on_by_one_word_and_keeps_its_place():
    rng = np.random.default_rng(3)
    lanes, steps, total = 7, 4000, np.uint64(1 << 25)
    starts = rng.integers(0, int(total) - 1, (steps, lanes)).astype(np.uint64)
    # Widths of one, of nearly all, and all, for lanes that have nothing to tell.
    widths = np.where(rng.random((steps, lanes)) < 0.7, np.uint64(1), total - starts)
    idle = rng.random((steps, lanes)) < 0.3
    starts[idle], widths[idle] = 0, total
    coder = rangecoder.Encoder(lanes)
    for start, width in zip(starts, widths):
        coder.put(start, width, total)
    words, counts = coder.finish()
    back = rangecoder.Decoder(words, counts)
    for start, width in zip(starts, widths):
        value = back.where(lanes, total)
        assert ((value >= start) & (value - start < width)).all()
        back.take(start, width)
    # 0.7 of 0.7 of the steps tell 25 bits each.
    assert words.nbytes * 8 < 1.05 * 25 * (widths == 1).sum() + 2 * steps * lanes


@pytest.mark.parametrize("n", [1, 127, 128, 129, 257, 8191, 120_000])
def test_lanes_of_any_length(n, monkeypatch):
    ids = np.minimum(np.random.default_rng(n).zipf(1.2, n), 50_000).astype(np.uint32)
    block = encode_block(ids)
    assert (decode_block(block) == ids).all()
    # Each lane ends with about a word and needs half of one to tell how many it has.
    assert len(block) < 40 + 10 * max(1, n // idcodec.LANE_IDS) + 2.5 * n
    monkeypatch.setattr(idcodec, "MAX_LANES", 3)
    assert (decode_block(encode_block(ids)) == ids).all()

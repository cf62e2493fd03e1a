import zlib

import cases
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from runlens.llm import wordcache
from runlens.llm.packing import Packer, pack, padding

PATH = public_tokenizers.path("word_bpe_49k.json")


def ids_of(text):
    found = Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids
    return np.array([*found, 2], "<u4")


def check(rows, pieces, window):
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault(p["doc_id"], []).append(p)
        by_sequence.setdefault(p["sequence_id"], []).append(p)
    for doc, text in rows:
        ids, copies = ids_of(text), [r for r in rows if r[0] == doc]
        assert sum(p["length"] for p in by_doc[doc]) == len(ids) * len(copies)
        for p in by_doc[doc]:
            own = ids[p["start"] : p["start"] + p["length"]]
            assert p["ids_crc32"] == zlib.crc32(own.tobytes()) and p["doc_tokens"] == len(ids)
    for own in by_sequence.values():
        at = 0
        for p in sorted(own, key=lambda p: p["offset"]):
            assert p["offset"] == at and p["length"] > 0
            at += p["length"]
        assert at <= window
    return by_sequence


@pytest.mark.parametrize("window,slots", [(4096, 32), (64, 3), (7, 1)])
def test_every_id_lies_in_one_piece(spark, window, slots):
    rows = [r for r in cases.ROWS if r[0] != 9 or window > 100]
    df = cases.frame(spark, rows, extra=True)
    pieces = pack(df, PATH, window=window, slots=slots)
    found = check([r[:2] for r in rows], pieces.collect(), window)
    short = [s for s in found.values() if sum(p["length"] for p in s) < window]
    assert len(short) <= 1
    assert padding(pieces, window).first()["padding"] < window / sum(p["length"] for s in found.values() for p in s)


def test_null_ids_and_empty_table(spark):
    rows = [(None, "one two three", None, None), (None, None, None, None)]
    pieces = pack(cases.frame(spark, rows), PATH).collect()
    assert len(pieces) == 2 and all(p["doc_id"] is None for p in pieces)
    assert pack(cases.frame(spark, []), PATH).count() == 0


def test_best_fit_then_the_fullest():
    packer = Packer(10, 2)
    put = lambda n, doc: list(packer.add((doc, 0, b"\0" * 4 * n, n)))
    assert put(4, 1) == [] and put(7, 2) == []
    assert packer.free == [(3, 1), (6, 0)]
    assert [p[0] for p in put(3, 3)[0]] == [2, 3]  # fits exactly where least room is left
    assert put(8, 4) == []
    full = put(7, 5)  # fits nowhere: fills the fullest, then the one opened next
    assert [p[0] for p in full[0]] == [4, 5] and len(full[0][1][2]) == 8
    assert [p[0] for p in next(packer.rest())]


def test_cached_words_equal_whole_texts(monkeypatch):
    monkeypatch.setattr(wordcache, "CACHED_WORDS", 4)
    wordcache._encoders.clear()
    encode = wordcache.encoder(PATH)
    texts = [
        "It's don't 'quoted' A.'s \"x.\" end.\nÉTÉ naïve ß İstanbul ΑΣ  ok?!",
        "tab\tvt\x0bff\x0c nbsp x  em é 1234 a1b2 -- ... \x1c\x85 <|endoftext|> z",
        "Straße, GROSS; größe: Ünï. co-op x_y #tag @me 50% £5",
        "",
        "日本語 テスト, смешанный ТЕКСТ.",
    ]
    whole = Tokenizer.from_file(PATH)
    for text in texts:
        expected = np.array(whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        assert encode(text) == expected, text
    wordcache._encoders.clear()

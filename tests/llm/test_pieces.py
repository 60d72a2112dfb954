import random

import sentencepiece

from linksift.llm.common import tokenizer_file
from linksift.llm import pieces
from linksift.llm.pieces import WORD, Pieces, decode_pieces, encode_pieces

PATH = tokenizer_file("piece_bpe_32k.model")


def some_texts():
    rng = random.Random(2)
    parts = ["a", "b", " ", "  ", "\n", "é", "the", "ing", "。", "\t", "🙂", "1", "tion", "\0", "zz"]
    return ["".join(rng.choice(parts) for _ in range(rng.randrange(20))) for _ in range(500)] + ["", " ", "x" * 200, "the " * 50]


def lists(coded):
    ids, at = coded
    return [ids[a:b].tolist() for a, b in zip(at, at[1:])]


def plain(sp, text, seed, doc_id, dropout):
    """Each word by looking at all neighbouring pairs for each merge, with its own arithmetic."""
    import hashlib

    full = (1 << 64) - 1

    def mixed(x):
        x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 & full
        x = (x ^ (x >> 27)) * 0x94D049BB133111EB & full
        return x ^ (x >> 31)

    salt = int.from_bytes(hashlib.blake2b(f"{seed}\0document\0{doc_id}".encode(), digest_size=8).digest(), "little")
    out = []
    for nth, word in enumerate(WORD.findall(" " + text) if text else []):
        key = mixed((salt + nth * 0x9E3779B97F4A7C15) & full)
        parts, at = list(word.replace(" ", "▁")), list(range(len(word) + 1))
        literal = {i for i, c in enumerate(word) if c == "▁"}  # the mark itself in a text is no blank
        while True:
            best = None
            for i in range(len(parts) - 1):
                if literal & set(range(at[i], at[i + 2])):
                    continue
                piece = sp.piece_to_id(parts[i] + parts[i + 1])
                pieces = [sp.piece_to_id(p) for p in (parts[i], parts[i + 1])]
                if sp.unk_id() in (piece, *pieces):
                    continue
                place = (at[i] << 42 ^ at[i + 1] << 21 ^ at[i + 2]) * 0x9E3779B97F4A7C15
                if mixed((key + place) & full) >> 11 < int(dropout * (1 << 53)):
                    continue
                rank = (-sp.get_score(piece), piece, i)
                if best is None or rank < best:
                    best = rank
            if best is None:
                break
            i = best[2]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del at[i + 1]
        for i, p in enumerate(parts):
            known = sp.piece_to_id(p) != sp.unk_id() and not literal & {at[i]}
            out += [sp.piece_to_id(p)] if known else [sp.piece_to_id(f"<0x{b:02X}>") for b in word[at[i] : at[i + 1]].encode()]
    return out


def test_without_dropout_as_the_library():
    sp, m = sentencepiece.SentencePieceProcessor(model_file=PATH), Pieces(PATH, 0, 0.0)
    texts = [t for t in some_texts() if "\0" not in t]
    assert lists(m.encode(texts, [0] * len(texts))) == [sp.encode(t) for t in texts]


def test_dropout_is_seeded_varied_and_lossless():
    texts = [*some_texts(), "▁ literal ▁▁ marks ▁x"]
    docs = list(range(len(texts)))
    cuts = {}
    for seed in (1, 2):
        m = Pieces(PATH, seed, 0.3)
        got = m.encode(texts, docs)
        assert m.decode(*got) == texts
        assert lists(got) == lists(m.encode(texts, docs)) == lists(Pieces(PATH, seed, 0.3).encode(texts, docs))
        # neither what stands beside a document nor what was cut before matters
        assert lists(got)[::-1] == lists(Pieces(PATH, seed, 0.3).encode(texts[::-1], docs[::-1]))
        cuts[seed] = got
    assert lists(cuts[1]) != lists(cuts[2])
    whole = Pieces(PATH, 0, 0.0).encode(texts, docs)
    assert len(cuts[1][0]) > len(whole[0])
    assert len(Pieces(PATH, 0, 1.0).encode(["the thing"], [1])[0]) == len(" the thing")


def test_every_occurrence_is_drawn_for_itself():
    m = Pieces(PATH, 4, 0.3)
    one_text = lists(m.encode(["international " * 200], [7]))[0]
    words, word = [], []
    for i in one_text:
        if m.raw[i].as_py().startswith(b" ") and word:
            words.append(tuple(word))
            word = []
        word.append(i)
    assert len(set(words)) > 20
    assert len({tuple(x) for x in lists(m.encode(["international"] * 200, list(range(200))))}) > 20


def test_share_of_dropped_merges():
    """A word of two characters with one merge is split as often as the rate says."""
    sp = sentencepiece.SentencePieceProcessor(model_file=PATH)
    assert len(sp.encode("a")) == 1
    ids, at = Pieces(PATH, 9, 0.1).encode(["a " * 20_000], [3])
    n_words = 20_000
    assert abs((len(ids) - 1 - n_words) / n_words - 0.1) < 0.01


def test_as_the_plain_version():
    sp = sentencepiece.SentencePieceProcessor(model_file=PATH)
    texts = [t for t in some_texts() if "\0" not in t][:250] + ["▁ literal ▁▁ marks ▁x", "internationalisation of uncharacteristically long words " * 3, "x" * 60]
    for seed, rate in ((1, 0.1), (2, 0.5)):
        got = lists(Pieces(PATH, seed, rate).encode(texts, list(range(len(texts)))))
        assert got == [plain(sp, t, seed, i, rate) for i, t in enumerate(texts)]


def test_forgotten_courses_change_nothing(monkeypatch):
    texts = some_texts()
    docs = list(range(len(texts)))
    want = lists(Pieces(PATH, 6, 0.2).encode(texts, docs))
    monkeypatch.setattr(pieces, "KEPT", 10)
    m = Pieces(PATH, 6, 0.2)
    assert [lists(m.encode([t], [i]))[0] for i, t in zip(docs, texts)] == want


def test_very_long_texts():
    rng = random.Random(8)
    texts = [" ".join(rng.choice(("the", "ing", "word", "zz")) for _ in range(30_000)), "".join(rng.choice("abcdehinot") for _ in range(30_000))]
    m = Pieces(PATH, 5, 0.1)
    assert m.decode(*m.encode(texts, [1, 2])) == texts


def test_documents(spark, odd_docs, no_docs, documents):
    for docs in (odd_docs, documents):
        coded = encode_pieces(docs, PATH, seed=5)
        rows = coded.collect()
        assert len(rows) == docs.count() and all(r.lossless and len(r.piece_ids) == r.n_pieces for r in rows)
    back = {r.doc_id: r.text for r in decode_pieces(encode_pieces(documents, PATH, seed=5), PATH).collect()}
    assert back == {r.doc_id: r.text for r in documents.select("doc_id", "text").collect()}
    assert encode_pieces(no_docs, PATH).collect() == []
    assert {r.n_pieces for r in encode_pieces(odd_docs.filter("text IS NULL OR text = ''"), PATH).collect()} == {0}

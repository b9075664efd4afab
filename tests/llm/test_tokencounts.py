"""Token counts against the library over whole texts."""

import random
import re

import pytest
from tests.llm.helpers import AWKWARD, frame, prose, text

from tidemark.llm.pieces import read_model
from tidemark.llm.queries import token_path
from tidemark.llm.tokencounts import ALPHABET, LETTERS, WHITE, WORD, PartCounts, boundaries, count_tokens, cut_text, margin, marks_of, middle

PARTS = ["<|endoftext|>", "<|endof", "|>", "'", "'re", "don't", " ", "   ", "\n", "\n \t ", "héé", "日本語の", "🙂", "x" * 30, " 12345", "!?", "...", "　", "á", " The", "{}"]


@pytest.fixture(scope="module")
def model():
    return read_model(token_path()).decode()


@pytest.fixture(scope="module")
def library(model):
    from tokenizers import Tokenizer

    return Tokenizer.from_str(model)


def noise(seed, n):
    rng = random.Random(seed)
    return "".join(rng.choice(PARTS) for _ in range(n))


def counted(df):
    return sorted(((r.doc_id, r.n_bytes, r.n_tokens) for r in df.collect()), key=repr)


def expected(library, texts, ids):
    return sorted(((i, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False))) for i, t in zip(ids, texts)), key=repr)


def test_chunks_and_whole_texts_agree(spark, model, library):
    texts = AWKWARD + [noise(k, 40 + 25 * k) for k in range(60)] + [text(prose(3, 900))]
    texts += [noise(5, 700)] * 3  # repeated long rows
    ids = [None if k % 11 == 0 else k for k in range(len(texts))]
    for step, overlap in ((150, 100), (400, 80)):
        found = count_tokens(frame(spark, texts, ids), model, step=step, overlap=overlap)
        assert found.columns == ["doc_id", "n_bytes", "n_tokens"]
        assert counted(found) == expected(library, texts, ids)


def test_wider_overlaps_where_nothing_aligns(spark, model, library):
    texts = ["x" * 5000, " " * 3000 + "end", noise(1, 300) + "y" * 4000 + noise(2, 300), "é" * 2000 + " " + "<|endoftext|>" * 300]
    assert counted(count_tokens(frame(spark, texts), model, step=200, overlap=80)) == expected(library, texts, range(4))


def test_every_boundary_outside_the_margin_is_one_of_the_whole_text(model, library):
    hidden = margin(model)
    for seed in range(150):
        whole = noise(seed, 40)
        raw = whole.encode()
        true = set(boundaries(library.encode(whole), raw)[0].tolist())
        for cut in range(hidden + 1, len(whole), 3):
            head = whole[:cut]
            at = boundaries(library.encode(head), head.encode())[0]
            assert set(at[at <= len(whole[: cut - hidden].encode())].tolist()) <= true


def test_chunks_cover_a_text_without_splitting_characters():
    raw = noise(9, 200).encode()
    places = list(cut_text(raw, 100, 30))
    assert places[0][0] == 0 and places[-1][1] == len(raw) and list(cut_text(b"", 5, 2)) == [(0, 0)]
    for (begin, end), (after, _) in zip(places, places[1:]):
        assert begin < after < end and raw[begin:end].decode()


def test_other_tokenizers_take_whole_texts(spark, library):
    import public_tokenizers
    from tokenizers import Tokenizer

    other = read_model(public_tokenizers.path("word_bpe_49k.json")).decode()
    assert margin(other) is None
    texts = [noise(3, 80), "A b" * 300]
    assert counted(count_tokens(frame(spark, texts), other, step=50, overlap=20)) == expected(Tokenizer.from_str(other), texts, range(2))


def test_empty_table(spark, model):
    assert count_tokens(frame(spark, []), model).collect() == []


def test_too_small_overlaps_are_refused(spark, model):
    with pytest.raises(ValueError):
        count_tokens(frame(spark, ["a"]), model, step=100, overlap=20)


class Recorder(PartCounts):
    """Counts the characters that are encoded."""

    given = 0

    def _encoded(self, parts):
        self.given += sum(map(len, parts))
        return super()._encoded(parts)


ODD = PARTS + ["\x85", "\u2028", "\x1c", "\u200b", "e\u0301", "д", "²", ".", ",", "'S", "ß;", "\xa0", "w.", "<|endoftext|>.", "?a"]


def test_counts_of_parts_add_up_to_those_of_whole_texts(model, library):
    rng = random.Random(8)
    texts = ["".join(rng.choice(ODD) for _ in range(rng.randrange(50))) for _ in range(6000)] + ["", " "]
    counter = PartCounts(library, marks_of(model))
    assert [n for k in range(0, len(texts), 500) for n in counter(texts[k : k + 500])] == [len(library.encode(t, add_special_tokens=False)) for t in texts]
    assert counter([]) == []


def test_words_met_before_are_not_encoded_again(model, library):
    rng = random.Random(2)
    words = [f"word{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(300)]
    texts = [" ".join(rng.choice(words) + rng.choice(["", "", ",", "."]) for _ in range(200)) for _ in range(100)]
    recorder = Recorder(library, marks_of(model))
    assert [n for t in texts for n in recorder([t])] == [len(library.encode(t)) for t in texts]
    assert recorder.given < 0.05 * sum(map(len, texts))


def test_counts_are_kept_for_few_and_short_parts(monkeypatch, model, library):
    monkeypatch.setattr("tidemark.llm.tokencounts.KEPT", 50)
    counter = PartCounts(library, marks_of(model))
    texts = [f"w{k % 70} " + "x" * k for k in range(200)] * 2
    assert [n for t in texts for n in counter([t])] == [len(library.encode(t)) for t in texts]
    assert max(map(len, [*counter.kept, *counter.before])) <= 64 and len(counter.kept) <= 53 and len(counter.before) <= 53


def test_white_space_and_letters_are_those_of_the_library(library):
    cut = library.pre_tokenizer.pre_tokenize_str
    white, letters = re.compile(f"[{WHITE}]"), re.compile(f"[{LETTERS}]")
    for k in [*range(0xD800), *range(0xE000, 0x11000)]:
        alone = all(len(cut(x + chr(k))) > 1 for x in "a1!")
        assert alone == bool(white.match(chr(k))), hex(k)
        if letters.match(chr(k)):
            assert len(cut("a" + chr(k))) == 1, hex(k)


def test_words_are_one_pre_token_in_the_alphabet_of_the_library(library):
    letters = [chr(k) for k in range(0x300) if re.fullmatch(f"[{LETTERS}]", chr(k))]
    words = ["s", "re", " d", " ll", " 0123456789", "7", "".join(letters), " " + "".join(letters[::-1])] + [x + y for x in (" ", "") for y in letters]
    for word in words:
        assert WORD.fullmatch(word) and [w for w, _ in library.pre_tokenizer.pre_tokenize_str(word)] == [word.encode().decode("latin-1").translate(ALPHABET)]


def test_special_strings_forbid_cuts_inside_them(model, library):
    from tokenizers import AddedToken, Tokenizer

    for special, marks in (("<a.b>", ",;:!?"), ("two words", None), ("letters", None), ("42", None), ("!a", ".,;:?")):
        other = Tokenizer.from_str(model)
        other.add_special_tokens([AddedToken(special, normalized=False)])
        assert marks_of(other.to_str()) == marks
        texts = [f"some {special}. and {special}{special}, a{special} b", special]
        assert PartCounts(other, marks)(texts) == [len(other.encode(t)) for t in texts]


def test_the_middle_of_a_chunk_lies_between_gaps_outside_its_ends():
    for seed in range(200):
        whole = noise(seed, 60)
        raw = whole.encode()
        for overlap, behind in ((20, len(raw)), (30, len(raw[: len(raw) - 30].decode(errors="ignore").encode()))):
            a, z = middle(whole, raw, overlap, behind)
            assert a <= z <= len(whole)
            if a < len(whole):
                assert overlap <= len(whole[:a].encode()) and len(whole[:z].encode()) <= behind
                assert all(re.match(f"[^{WHITE}][{WHITE}]", whole[k - 1 :]) for k in (a, z))
    assert middle("x" * 90, b"x" * 90, 10, 80) == (90, 90)
    far = "a" * 50 + " b" + "c" * 900
    assert middle(far, far.encode(), 10, 900) == (50, 50)

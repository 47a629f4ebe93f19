import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from mixlab.llm import text, tokens
from mixlab.llm.packing import RoomTree, best_fit_decreasing, pack
from mixlab.llm.token_counts import context_report, length_histogram, token_counts, token_lengths, truncated_total
from mixlab.llm.tokens import WordEncoder, tokenizer_path
from mixlab.llm.text import Words, string_buffers

ODD = [
    (1, None), (2, ""), (3, " \t\n"), (4, "It's 7 o'clock 77 777"), (5, "naïve   Ünïcode ﬁ é ́x"),
    (6, "<|endoftext|> a<|startoftext|>b"), (7, "word " * 9000), (8, "x" * 20000), (9, "a b c d\x1ce"),
    (4, "It's 7 o'clock 77 777"), (None, "no id"), (11, "7 7 7 a7 ７ 7"),
]


@pytest.fixture(scope="module")
def whole():
    tokenizer = Tokenizer.from_file(tokenizer_path())
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def one_by_one(lengths, capacity):
    """Plain best fit decreasing: the number of bins."""
    rooms = []
    for length in sorted(lengths, reverse=True):
        fitting = [i for i, room in enumerate(rooms) if room >= length]
        if fitting:
            rooms[min(fitting, key=lambda i: rooms[i])] -= length
        else:
            rooms.append(capacity - length)
    return sorted(rooms)


@pytest.mark.parametrize("seed", range(6))
def test_runs_equal_plain_best_fit(seed):
    draw = np.random.default_rng(seed)
    capacity = int(draw.integers(5, 60))
    lengths = draw.integers(1, capacity + 1, 300).tolist()
    histogram = {n: lengths.count(n) for n in set(lengths)}
    runs, bins = best_fit_decreasing(histogram, capacity)
    spans = defaultdict(list)
    for length, count in histogram.items():
        for rank in range(count):
            first, start, per_bin, offset = next(r for r in runs[length][::-1] if r[0] <= rank)
            along = rank - first
            spans[start + along // per_bin].append((offset + along % per_bin * length, length))
    assert sorted(spans) == list(range(bins))
    rooms = []
    for held in spans.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        rooms.append(capacity - at)
    assert sorted(rooms) == one_by_one(lengths, capacity)


def test_tree_finds_tightest():
    tree = RoomTree(10)
    assert tree.tightest(0) is None
    tree.add(7, 2)
    tree.add(3, 1)
    assert [tree.tightest(n) for n in (0, 3, 4, 7, 8)] == [3, 3, 7, 7, None]


def test_word_ids_are_text_ids(whole, corpus):
    coder = WordEncoder(tokenizer_path(), capacity=50)
    texts = [t for _, t in ODD] + [r["text"] for r in corpus.limit(60).collect()]
    import pyarrow as pa

    words = Words(*string_buffers(pa.array(texts, pa.string())))
    assert [d.tolist() for d in coder.documents(words)] == [whole(t) for t in texts]
    assert coder.counts(words).tolist() == [len(whole(t)) for t in texts]
    fresh = WordEncoder(tokenizer_path())
    assert fresh.counts(words).tolist() == [len(whole(t)) for t in texts]


def check(rows, source, whole, capacity):
    want = {}
    for doc_id, text in source:
        ids = np.array([*whole(text), 1], "<u4")
        for low in range(0, len(ids), capacity):
            part = ids[low : low + capacity]
            want.setdefault((doc_id, low // capacity, low, len(part), zlib.crc32(part.tobytes())), []).append(1)
    got = defaultdict(list)
    spans = defaultdict(list)
    for r in rows:
        got[(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"])].append(1)
        spans[r["sequence_id"]].append((r["offset"], r["length"]))
    assert got == want
    for held in spans.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(spans) == len(one_by_one([k[3] for k, v in want.items() for _ in v], capacity))


def test_pack_odd_rows(documents, whole):
    check(pack(documents(ODD)).collect(), ODD, whole, 4096)
    check(pack(documents(ODD), capacity=64).collect(), ODD, whole, 64)
    assert pack(documents([])).collect() == []


def test_pack_corpus(corpus, whole):
    check(pack(corpus).collect(), [(r["doc_id"], r["text"]) for r in corpus.collect()], whole, 4096)


def test_counts_for_every_limit(documents, whole):
    docs = documents(ODD)
    lengths = [len(whole(t)) for _, t in ODD]
    report = context_report(length_histogram(token_lengths(docs)), span=3)
    for r in report.collect():
        at = r["length"]
        assert r["n_docs"] == lengths.count(at) and r["n_tokens"] == at * r["n_docs"]
        assert r["docs_longer"] == sum(n > at for n in lengths)
        assert r["tokens_longer"] == sum(n for n in lengths if n > at)
        assert r["docs_up_to"] == sum(n <= at for n in lengths)
        assert r["quantile"] == pytest.approx(sum(n <= at for n in lengths) / len(lengths))
        assert r["truncated_total"] == sum(min(n, at) for n in lengths)
        assert r["total_tokens"] == sum(lengths)
    for limit in (0, 1, 5, 100, 10**6):
        assert truncated_total(report, limit) == sum(min(n, limit) for n in lengths)
    assert token_counts(documents([])).collect() == []


def test_a_full_cache_keeps_the_words_in_use():
    import pyarrow as pa

    coder = WordEncoder(tokenizer_path(), capacity=6000)
    common = "the cat sat on the mat "
    for lot in range(12):
        texts = [common * 3 + " ".join(f"rare{lot}x{i}" for i in range(40))]
        words = Words(*string_buffers(pa.array(texts, pa.string())))
        assert coder.counts(words).tolist() == [len(coder.tokenizer.encode(texts[0], add_special_tokens=False).ids)]
        assert coder.size() <= 6000 + 40 * 80
    known = Words(*string_buffers(pa.array([common], pa.string()))).hashes()
    assert coder._places(known)[1].all()


def test_buckets_follow_each_length(documents, monkeypatch):
    """A length is cut into as many buckets as it has rows for; rare ones are not cut."""
    from mixlab.llm import packing, ranks

    monkeypatch.setattr(packing, "bucket_count", lambda rows: ranks.bucket_count(rows, 10))
    rows = [(i, "cat " * (1 if i % 10 else 1 + i % 37)) for i in range(400)]
    placed = packing.pack(documents(rows)).collect()
    ends = Counter()
    for r in sorted(placed, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == ends[r["sequence_id"]]
        ends[r["sequence_id"]] += r["length"]
    assert len(placed) == 400 and max(ends.values()) <= 4096


def test_workers_give_back_what_they_keep():
    from mixlab.llm import text, tokens

    first = tokens.encoder(tokenizer_path())
    assert tokens.encoder(tokenizer_path()) is first and text.powers(3, 10)[2] == 9
    text.give_back()
    assert not text._kept and not text._powers
    assert tokens.encoder(tokenizer_path()) is not first


def test_an_encoding_task_frees_what_other_operators_kept():
    path = tokens.tokenizer_path()
    texts = ["one two 7", None, "", "three one", "two  four\n77"]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    own = tokens.encoder(path)
    text.keep("other", lambda: object())
    turns = tokens.encoded(iter([batch]), "text", path)
    _, coder, words = next(turns)
    assert coder is own and "other" not in text._kept
    plain = own.tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)
    assert [d.tolist() for d in coder.documents(words)] == [e.ids for e in plain]
    text.keep("other", lambda: object())
    assert list(turns) == [] and list(text._kept) == [f"tokens {path}"]


def test_new_words_are_held_as_strings_one_lot_at_a_time(monkeypatch):
    monkeypatch.setattr(tokens, "_LOT", 3)
    coder, sizes = tokens.WordEncoder(tokens.tokenizer_path()), []
    whole = coder._encode
    monkeypatch.setattr(coder, "_encode", lambda lot: sizes.append(len(lot)) or whole(lot))
    words = text.Words(*text.string_buffers(pa.array(["a bc 7 def", "gh b 17 ij kl"])))
    coder._add(*(lambda h: (h, words, np.arange(len(h))))(words.hashes()))
    assert sizes == [3, 3, 3] and len(coder.keys) == 9


def _words(line):
    return text.Words(*text.string_buffers(pa.array([line])))


def test_a_full_cache_keeps_the_words_that_came_again():
    coder = WordEncoder(tokenizer_path())
    for line in ("alpha beta gamma", "alpha delta", "epsilon beta"):
        coder.spans(_words(line))
    coder.capacity = coder.size() - 1
    line = "zeta gamma alpha"
    assert [d.tolist() for d in coder.documents(_words(line))] == [coder.tokenizer.encode(line, add_special_tokens=False).ids]
    # Delta and epsilon came once and made room; gamma was taken in anew.
    _, there = coder._places(_words("alpha beta gamma delta epsilon zeta").hashes())
    assert there.tolist() == [True, True, True, False, False, True]


def test_an_encoding_task_returns_memory_after_each_chunk(monkeypatch):
    returned = []
    monkeypatch.setattr(tokens, "trim", lambda: returned.append(1))
    cut = tokens.chunks
    monkeypatch.setattr(tokens, "chunks", lambda batch, name: cut(batch, name, 8))
    batch = pa.RecordBatch.from_arrays([pa.array(["one two three", "four five six", "seven"])], names=["text"])
    assert len(list(tokens.encoded(iter([batch]), "text", tokens.tokenizer_path()))) == len(returned) == 3

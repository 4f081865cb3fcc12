"""Token alignment against whole-text encoders and a brute force over bytes."""

import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from parcelwright.llm import alignment, queries

SPACES = " \t\n\r\x0b\x0c\x1c\x85\xa0    　"


@pytest.fixture(scope="module")
def aligner():
    return alignment.Aligner("byte_bpe_50k.json", "piece_bpe_32k.model")


def whole(aligner, text):
    """Ids of whole texts by both vocabularies, the first by its own library, or None if bytes differ."""
    if not text:
        return None
    a = aligner.a.slow.encode(" " + text, add_special_tokens=False).ids
    b = aligner.b.model.encode(text)
    own = (" " + text).encode()
    if b"".join(aligner.a.bytes[i] for i in a) != own or b"".join(aligner.b.bytes[i] for i in b) != own:
        return None
    return a, b


def ranges(ids, sizes):
    ends = np.cumsum([sizes[i] for i in ids]).tolist()
    return list(zip([0, *ends], ends))


def brute(aligner, text):
    """Groups and links of a text, links by comparing all byte ranges."""
    found = whole(aligner, text)
    if found is None:
        return None
    a, b = found
    ra, rb = ranges(a, aligner.a_size), ranges(b, aligner.b_size)
    cuts = sorted({e for _, e in ra} & {e for _, e in rb})
    shown, lo = [], 0
    for hi in cuts:
        shown.append(",".join(str(i) for i, (s, e) in zip(a, ra) if lo <= s < hi) + "|" + ",".join(str(i) for i, (s, e) in zip(b, rb) if lo <= s < hi))
        lo = hi
    links = [(x, y) for x, (s, e) in zip(a, ra) for y, (t, f) in zip(b, rb) if s < f and t < e]
    return len(a), len(b), shown, links


def expected(aligner, texts):
    each = [brute(aligner, t) for t in texts]
    count = Counter(p for x in each if x for p in set(x[3]))
    most = {}
    for (a, _), n in count.items():
        most[a] = max(n, most.get(a, 0))
    return [
        (0, 0, 0, 0, 0, 0, "") if x is None else (x[0], x[1], len(x[2]), len(x[3]), sum(count[p] == most[p[0]] for p in x[3]), sum(count[p] for p in x[3]), hashlib.sha256(";".join(x[2]).encode()).hexdigest())
        for x in each
    ]


@settings(max_examples=300, deadline=None)
@given(texts=st.lists(st.text(alphabet=st.one_of(st.sampled_from("abcdeéÉ'st.,!0129▁<|>中文🙂́" + SPACES), st.characters(codec="utf-8")), max_size=40), max_size=6))
def test_segments_encode_as_whole_texts(aligner, texts):
    texts = texts + ["<|endoftext|> </s> <s>x<unk> <0x41>", " a", "a  b   c ", "  ", "x \n  y", "é é"]
    numbers, shown, doc, pairs = aligner.align(pa.array(texts, pa.string()))
    for i, text in enumerate(texts):
        want = brute(aligner, text)
        own = sorted(divmod(int(p), alignment.SECOND) for p in pairs[doc == i])
        if want is None:
            assert numbers[i].tolist() == [0, 0, 0, 0] and shown[i] == "" and not own
        else:
            assert numbers[i].tolist() == [want[0], want[1], len(want[2]), len(want[3])] and shown[i] == ";".join(want[2]) and own == sorted(want[3])


@settings(max_examples=200, deadline=None)
@given(a=st.lists(st.integers(1, 4), min_size=1, max_size=12), data=st.data())
def test_groups_and_links_of_any_lengths(a, data):
    left, b = sum(a), []
    while left:
        b.append(data.draw(st.integers(1, min(4, left))))
        left -= b[-1]
    ids_a, ids_b = list(range(len(a))), list(range(len(b)))
    made = list(alignment.groups(ids_a, ids_b, a, b))
    assert sum((x for x, _, _ in made), []) == ids_a and sum((y for _, y, _ in made), []) == ids_b
    ra, rb = ranges(ids_a, a), ranges(ids_b, b)
    assert [p for *_, links in made for p in links] == sorted((x, y) for x, (s, e) in enumerate(ra) for y, (t, f) in enumerate(rb) if s < f and t < e)
    assert len(made) == len({e for _, e in ra} & {e for _, e in rb})


def test_odd_rows(spark, aligner):
    texts = [None, "", " ", "plain words here", "plain words here", "é ▁ x", "tail  ", "x" * 70_000, "long words " * 20_000, " " * 100_000 + "a", "a\x00b"]
    rows = [(i, t, 1, "x") for i, t in enumerate(texts)] + [(None, "plain", 1, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_a int, `chunk` string")
    short = [t if t is None or len(t) < 1000 else t for t in texts]
    want = expected_fast(aligner, [*short, "plain"])
    got = {r.doc_id: tuple(r)[1:] for r in alignment.align(docs).collect()}
    assert got == dict(zip([*range(len(texts)), None], want))
    assert alignment.align(docs.limit(0)).count() == 0


def expected_fast(aligner, texts):
    """As expected, with links by sorted ends, for texts too long to compare all ranges."""
    each = []
    for t in texts:
        found = whole(aligner, t)
        if found is None:
            each.append(None)
            continue
        a, b = found
        ea, eb = np.cumsum([aligner.a_size[i] for i in a]), np.cumsum([aligner.b_size[i] for i in b])
        ends = np.union1d(ea, eb)
        links = list(zip((a[i] for i in np.searchsorted(ea, ends)), (b[i] for i in np.searchsorted(eb, ends))))
        common = np.intersect1d(ea, eb)
        ia, ib = np.searchsorted(ea, common) + 1, np.searchsorted(eb, common) + 1
        shown = [f"{','.join(map(str, a[i:j]))}|{','.join(map(str, b[k:m]))}" for i, j, k, m in zip([0, *ia], ia, [0, *ib], ib)]
        each.append((len(a), len(b), shown, links))
    count = Counter(p for x in each if x for p in set(x[3]))
    most = {}
    for (a, _), n in count.items():
        most[a] = max(n, most.get(a, 0))
    return [(0, 0, 0, 0, 0, 0, "") if x is None else (x[0], x[1], len(x[2]), len(x[3]), sum(count[p] == most[p[0]] for p in x[3]), sum(count[p] for p in x[3]), hashlib.sha256(";".join(x[2]).encode()).hexdigest()) for x in each]


def test_both_brute_forces_agree(aligner):
    texts = ["some words, and more of them", "é'été 12345", None, "a  b", "some words"]
    assert expected(aligner, texts) == expected_fast(aligner, texts)


def test_query_over_the_table(spark, sf_dir, aligner):
    rows = queries.table(spark, sf_dir, "documents").select("doc_id", "text").collect()
    want = dict(zip((r.doc_id for r in rows), expected_fast(aligner, [r.text for r in rows])))
    assert {r.doc_id: tuple(r)[1:] for r in queries.op12_align_tokens(spark, sf_dir).collect()} == want


def test_pairs_of_the_corpus(spark):
    docs = spark.createDataFrame([(1, "one two"), (2, "one one"), (3, None)], "doc_id long, text string")
    a = alignment.Aligner("byte_bpe_50k.json", "piece_bpe_32k.model")
    count = Counter(p for t in ("one two", "one one") for p in set(brute(a, t)[3]))
    assert {(r.a, r.b): r.n_docs for r in alignment.links(docs).collect()} == dict(count)

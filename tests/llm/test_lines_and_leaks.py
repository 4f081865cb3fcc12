"""Line dedup and decontamination against brute force and planted cases."""

import hashlib
import random
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from parcelwright.llm import decontaminate, lines

ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def folded(text):
    return re.findall(ALNUM, (text or "").translate(AZ))


def test_contamination(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    items += [(900, "Short one"), (901, ""), (902, None), (903, "zz " * 12), (904, "short ONE")]
    docs += [(-1, None), (-2, ""), (-3, "a short-one b short one"), (-4, "zz " * 25), (-5, "x " + items[0][1] + " y"), (-5, "x " + items[0][1] + " y"), (-6, " ".join(items[1][1].split()[:9]))]
    got = Counter((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in decontaminate.contamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect())
    table = defaultdict(set)
    for i, t in items:
        w = folded(t)
        k = min(10, len(w))
        for at in range(len(w) - k + 1) if k else ():
            table[tuple(w[at : at + k])].add(str(i))
    want = Counter()
    for d, t in docs:
        w, hit, ids = folded(t), set(), set()
        for k in {len(x) for x in table}:
            for at in range(len(w) - k + 1):
                if found := table.get(tuple(w[at : at + k])):
                    hit |= set(range(at, at + k))
                    ids |= found
        want[d, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)] += 1
    assert got == want
    shuffled = decontaminate.contamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), broadcast_rows=0)
    assert Counter((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in shuffled.collect()) == want


def test_decontaminate_keeps_the_rest(spark):
    item = "one two three four five six seven eight nine ten eleven"
    docs = spark.createDataFrame([(1, f"Before, {item.upper()}! after."), (2, "clean text."), (3, None), (4, item)], "doc_id long, text string")
    for name in ("n_words", "_hits", "_hit_doc", "_hit_text", "_row", "ws", "th", "window", "_known", "item", "phrase", "a.b"):
        docs = docs.withColumn(name, F.lit("mine"))
    bench = spark.createDataFrame([(5, item)], "item_id long, text string")
    assert sorted(r.doc_id for r in decontaminate.decontaminate(docs, bench).collect()) == [2, 3]
    cut = {r.doc_id: r.text for r in decontaminate.decontaminate(docs, bench, spans=True).collect()}
    assert cut[2] == "clean text." and cut[3] is None and folded(cut[1]) == ["before", "after"] and folded(cut[4]) == []
    assert decontaminate.decontaminate(docs, bench).columns == docs.columns
    assert decontaminate.decontaminate(docs, bench.limit(0)).count() == 4
    assert decontaminate.contamination(docs.limit(0), bench).count() == 0


def test_contamination_of_a_very_long_text(spark):
    """A passage at the end of 300 000 words is found, and cutting it leaves the rest."""
    item = " ".join(f"item{i}" for i in range(12))
    long = " ".join(f"w{i % 977}" for i in range(300_000))
    docs = spark.createDataFrame([(1, f"{long} {item}"), (2, long)], "doc_id long, text string")
    bench = spark.createDataFrame([(5, item)], "item_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items) for r in decontaminate.contamination(docs, bench).collect()}
    assert got == {1: (300_012, 12, 1), 2: (300_000, 0, 0)}
    assert {r.doc_id: r.text.strip() for r in decontaminate.decontaminate(docs, bench, spans=True).collect()} == {1: long, 2: long}


def line(rng, n):
    return " ".join("".join(rng.choices("abcdefghijklmnop", k=6)) for _ in range(n))


def test_flags_let_the_known_pass_and_stay_small(spark, capsys):
    """All known windows pass and few others do; the driver's plans, which hold the flags again and again, stay small."""
    known = spark.range(20_000).select(F.xxhash64(F.concat(F.lit("k"), F.col("id").cast("string"))).alias("_known"))
    flags = decontaminate.window_flags(known, 20)
    window = spark.range(40_000).select("id", F.xxhash64(F.concat(F.lit("k"), F.col("id").cast("string"))).alias("window"))
    got = {r.known: r.n for r in window.where(decontaminate._flagged(F.col("window"), flags, 20)).groupBy((F.col("id") < 20_000).alias("known")).agg(F.count("*").alias("n")).collect()}
    assert got[True] == 20_000 and 0 < got[False] < 800
    ws = spark.createDataFrame([(1, ["w"] * 30)], "doc_id long, ws array<string>")
    decontaminate.hashed_windows(ws, [3, 10], ["doc_id"], flags, 20).explain("formatted")
    assert len(capsys.readouterr().out) < 1_500_000  # 12.5 MB with an element for each flag


def test_planted_passages_go_and_clean_texts_stay(spark):
    rng = random.Random(3)
    passages = [[line(rng, rng.randint(6, 20)) for _ in range(rng.randint(5, 9))] for _ in range(20)] + [[line(rng, 60)] for _ in range(10)]
    docs, planted = [], []
    for d in range(300):
        body = [line(rng, rng.randint(3, 25)) for _ in range(rng.randint(2, 15))]
        if d % 3 == 0:
            at, passage = rng.randint(0, len(body)), passages[rng.randrange(len(passages))]
            body[at:at] = passage
            planted.append((d, passage))
        docs.append((d, "\n".join(body)))
    docs += [(1000, None), (1001, ""), (1002, "\n\n"), (1003, docs[1][1]), (5, docs[5][1])]
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumn("n_removed", F.lit("old"))
    out = {r.doc_id: r for r in lines.dedup_lines(frame).collect()}
    first, gone, words = set(), 0, 0
    for d, passage in planted:
        key = "\n".join(passage)
        if key in first:
            left = out[d].text.split("\n")
            gone += sum(len(x.split()) for x in passage if x not in left)
            words += sum(len(x.split()) for x in passage)
            assert any(x not in left for x in passage)
        else:
            assert out[d].text == dict(docs)[d]
        first.add(key)
    assert gone > 0.85 * words
    clean = [d for d in range(300) if d % 3]
    assert all(out[d].text == dict(docs)[d] and out[d].n_removed == 0 for d in clean)
    assert out[1000].text is None and out[1001].text == "" and out[1002].text == "\n\n"
    assert out[1003].n_removed > 0.5 * out[1003].n_lines
    report = Counter((r.doc_id, r.n_lines, r.n_removed, r.removed_words) for r in lines.line_report(frame).collect())
    assert report == Counter((r.doc_id, r.n_lines, r.n_removed, r.removed_words) for r in lines.dedup_lines(frame).collect())
    assert sum(report.values()) == len(docs)
    assert lines.dedup_lines(frame.limit(0)).count() == 0


def test_repeats_are_real(spark, sf_dir):
    """Every removed line stands, with a neighbour or as a long passage, somewhere earlier or in another document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    pairs = Counter()
    for r in docs.collect():
        ls = r.text.split("\n")
        pairs.update(set(zip(ls, ls[1:])) | {(x,) for x in set(ls)})
    text = {r.doc_id: r.text for r in docs.collect()}
    for r in lines.repeated_chunks(docs).collect():
        ls = text[r.doc_id].split("\n")[r.start : r.start + r.n]
        total = Counter(text[r.doc_id].split("\n"))
        assert all(pairs[p] > 1 or total[p[0]] > 1 for p in (zip(ls, ls[1:]) if len(ls) > 1 else [(ls[0],)]))


def test_passages_shared_by_two_documents_go(spark):
    rng = random.Random(9)
    docs, want, before = [], {}, {}
    for k in range(300):
        words = [rng.randint(25, 49) for _ in range(2)] if k < 150 else [rng.randint(1, 9) for _ in range(rng.randint(2, 6))]
        passage = [line(rng, n) for n in words]
        for d in (2 * k, 2 * k + 1):
            head, tail = ([line(rng, rng.randint(3, 25)) for _ in range(rng.randint(0, 6))] for _ in range(2))
            docs.append((d, "\n".join(head + passage + tail)))
            before[d] = docs[-1][1]
            want[d] = "\n".join(head + tail) if d % 2 and sum(words) >= 12 else docs[-1][1]
    same, other = line(rng, 12), line(rng, 13)
    docs += [(1000, "\n".join([same] * 3)), (1001, "\n".join([other] * 5))]
    want |= {1000: docs[-2][1], 1001: "\n".join([other] * 2)}
    got = {r.doc_id: r.text for r in lines.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert all(got[d] == want[d] for d in want if d % 2 == 0 or d > 999)  # first occurrences stay
    assert all(set(want[d].split("\n")) <= set(got[d].split("\n")) for d in want)  # lines outside passages stay
    n = lambda t: len(t.split())
    for part, least in ((range(1, 300, 2), 0.97), (range(301, 600, 2), 0.9)):
        gone, should = sum(n(before[d]) - n(got[d]) for d in part), sum(n(before[d]) - n(want[d]) for d in part)
        assert gone >= least * should, (gone, should)  # of passages of two long lines, and of ones that barely count


def signed(h):
    return h - (1 << 64) if h >> 63 else h


def marks_of(texts):
    """For each line and the next: the families in which they are a boundary, as bits."""
    from struct import pack

    import xxhash

    hashes = [xxhash.xxh64_intdigest(x.encode(), 42) for x in texts]
    pair = lambda a, b: xxhash.xxh64_intdigest(pack("<q", signed(b)), xxhash.xxh64_intdigest(pack("<q", signed(a)), 42))
    return [pair(a, b) & ((1 << lines.FAMILIES) - 1) for a, b in zip(hashes, hashes[1:])]


def brute_spans(texts, counts):
    """(first, last) of the chunks of lines with words: family by family, and boundary by boundary."""
    marks, n, found = marks_of(texts), len(texts), set()
    for family in range(lines.FAMILIES):
        begins = {i for i, m in enumerate(marks) if m >> family & 1}
        ends = {i + 1 for i in begins}
        for i in begins:
            j = next((j for j in range(i + 1, n) if sum(counts[i : j + 1]) >= lines.CHUNK_WORDS), None)
            if j is not None:
                last = next((e for e in range(j, j + lines.REACH) if e in ends), j + lines.REACH)
                if last < n:
                    found.add((i, last))
        for j in ends:
            i = next((i for i in range(j - 1, -1, -1) if sum(counts[i : j + 1]) >= lines.CHUNK_WORDS), None)
            if i is not None:
                first = next((b for b in range(i, i - lines.REACH, -1) if b in begins), i - lines.REACH)
                if first >= 0:
                    found.add((first, j))
    return found | {(i, i) for i, c in enumerate(counts) if c >= lines.PASSAGE_WORDS}


def brute_report(rows):
    """n_lines, n_words, n_removed, removed_words of each row, by going over all chunks in plain Python."""
    docs = list(dict.fromkeys((d, t) for d, t in rows))
    spans = {}
    for d, t in docs:
        ls = (t or "").split("\n")
        counts = [len(re.findall(r"[^ \t-\r]+", x)) for x in ls]
        at = [i for i, c in enumerate(counts) if c]
        found = {(at[i], at[j] - at[i] + 1) for i, j in brute_spans([ls[i] for i in at], [counts[i] for i in at])}
        spans[d, t] = ls, counts, found
    places = defaultdict(list)
    for key, (ls, _, found) in spans.items():
        for i, n in found:
            places["\n".join(ls[i : i + n]), n].append((key, i))
    gone = defaultdict(set)
    for (_, n), at in places.items():
        if len(at) < 2:
            continue
        at.sort(key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
        first = at[0]
        for key, i in at[1:]:
            if not (key == first[0] and i < first[1] + n):
                gone[key] |= set(range(i, i + n))
    for d, t in rows:
        ls, counts, _ = spans[d, t]
        yield d, len(ls), sum(counts), len(gone[d, t]), sum(counts[i] for i in gone[d, t])


def test_line_report_against_brute_force(spark):
    """Indented code, blank-heavy lines, shared passages of all lengths, repeats inside a text, a very long text, nulls."""
    rng = random.Random(21)
    pool = [line(rng, n) for n in (1, 2, 3, 5, 8, 12, 20, 49, 50, 70)]
    odd = ["", " ", "    " * 20, " " * 60 + "end", "\t\treturn x", "}", "    if a:", "x  " * 5]
    rows = []
    for d in range(200):
        body = [rng.choice(pool) if rng.random() < 0.3 else rng.choice(odd) if rng.random() < 0.5 else line(rng, rng.randint(1, 15)) for _ in range(rng.randint(0, 25))]
        rows.append((d, "\n".join(body)))
    rows += [(300, None), (301, ""), (None, rows[5][1]), (7, rows[7][1]), (400, "\n".join(line(rng, rng.randint(1, 9)) for _ in range(4000)) + "\n" + rows[9][1]), (401, "word " * 60_000), (402, "word " * 60_000)]
    rows += [(1000, " " * 60 + "end"), (1001, " " * 60 + "end"), (1002, " " * 55 + "\n" + " " * 55)]
    got = Counter(tuple(r) for r in lines.line_report(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", "n_lines", "n_words", "n_removed", "removed_words").collect())
    assert got == Counter(brute_report(rows))
    assert all(r.n_removed == 0 for r in lines.line_report(spark.createDataFrame(rows[-3:], "doc_id long, text string")).collect())

"""Operators that look at each row alone, against plain brute-force versions."""

import hashlib
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from parcelwright.llm import chat, licenses, mixing, quality, queries, urls

ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BLANK = r"[^\x20\x09-\x0D]+"
ODD = [None, "", " ", "\n\n", "a", "a b a b a b", "x\nx\n\nx y\nx y", "Été ÉTÉ\u00a0été", "mit license " * 3, "cc by cc by cc by", "word " * 5000]
AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def texts(spark, sf_dir):
    given = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    return given + [(-i - 1, t) for i, t in enumerate(ODD)] + [(-1, None), (-6, ODD[5])]


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_license_base_columns(spark, sf_dir):
    rows = texts(spark, sf_dir)
    got = Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in licenses.license_scan(frame(spark, rows)).collect())
    want = Counter()
    for d, t in rows:
        words = re.findall(ALNUM, (t or "").translate(AZ))
        at, labels = [], set()
        for phrase, label in licenses.PHRASES.items():
            p = phrase.split()
            found = [i for i in range(len(words)) if words[i : i + len(p)] == p]
            at += found
            labels |= {label} if found else set()
        want[d, len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))] += 1
    assert got == want


def pattern(markup):
    """A template as a regular expression over words that each end in a blank."""
    out = ""
    for part in markup.split():
        out += "(?:" if part == "((" else ")?" if part == "))" else rf"(?:\S+ ){{0,{part[2:-2]}}}" if part.startswith("{{") else re.escape(part) + " "
    return out


def test_license_templates_against_regex(spark):
    rng = np.random.default_rng(1)
    vocab = sorted({w for t in licenses.TEMPLATES.values() for w in t.split() if w not in ("((", "))") and "{" not in w})
    rows = []
    for i in range(300):
        words = list(rng.choice(vocab, 30))
        key = list(licenses.TEMPLATES)[i % len(licenses.TEMPLATES)]
        body = []
        for part in licenses.TEMPLATES[key].split():
            if part in ("((", "))"):
                continue
            body += list(rng.choice(vocab, 2)) if "{" in part else [part]
        if i % 3 == 0:
            body.pop(int(rng.integers(len(body))))
        at = int(rng.integers(30))
        rows.append((i, " ".join(words[:at] + body + words[at:])))
    for r in licenses.license_scan(frame(spark, rows)).collect():
        text = " ".join(re.findall(ALNUM, rows[r.doc_id][1])) + " "
        want = {k for k, t in licenses.TEMPLATES.items() if re.search(r"(?:^| )" + pattern(t), text)} | {v for k, v in licenses.PHRASES.items() if f" {k} " in f" {text}"}
        assert set(filter(None, r.labels.split(","))) == want
        assert abs(r.score - (1.0 if want else share(text))) < 1e-9


def share(text):
    """The largest share of a template's mandatory words that stand in order, from where two words stand."""
    best = 0.0
    for markup in licenses.TEMPLATES.values():
        parts, depth, ends = markup.split(), 0, []
        for i, part in enumerate(parts):
            depth += (part == "((") - (part == "))")
            if not depth and part != "))" and "{" not in part:
                ends.append(i + 1)
        for n, end in enumerate(ends, 1):
            wild = parts[1] == "((" if n == 1 else True
            if not wild or not re.search(r"(?:^| )" + pattern(" ".join(parts[:end])) + (r"\S+ " if n == 1 else ""), text):
                if n > 1:
                    break
                continue
            best = max(best, n / len(ends))
    return best


def test_license_regions():
    nested = licenses.Scanner({}, {"x": "one two (( three (( four )) five )) six"})
    accepted = lambda t: nested.scan(t.encode())[5] == "x"
    assert all(map(accepted, ["one two six", "one two three five six", "one two three four five six"]))
    assert not any(map(accepted, ["one two four six", "one two three four six", "one two five six", "one two"]))
    for wrong in ("one (( two", "one two ))", "(( one two ))", "{{3}} one"):
        with pytest.raises(ValueError):
            licenses.compile_template("x", wrong)


def test_license_scan_is_linear():
    import time

    scanner = licenses.Scanner(licenses.PHRASES, licenses.TEMPLATES)
    took = []
    for n in (20_000, 40_000):
        began = time.process_time()
        got = scanner.scan(("licensed under " * n + "cc by " * n).encode())
        took.append(time.process_time() - began)
        assert got[:4] == (4 * n, n, 2 * n, 4 * n - 2)
    assert took[1] < 3 * took[0] + 0.2


def test_quality_base_columns(spark, sf_dir):
    rows = texts(spark, sf_dir)
    trees = quality.boost(np.zeros((0, len(quality.FEATURES))), np.zeros(0), np.zeros(len(quality.FEATURES)))
    got = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in quality.score(frame(spark, rows), trees).collect())
    want = Counter()
    for d, t in rows:
        words, seen, dup, cover = re.findall(BLANK, t or ""), set(), 0, set()
        for line in (t or "").split("\n"):
            if re.search(BLANK, line):
                dup += line in seen
                seen.add(line)
        grams = Counter(zip(words, words[1:], words[2:]))
        for i in range(len(words) - 2):
            if grams[tuple(words[i : i + 3])] > 1:
                cover |= {i, i + 1, i + 2}
        n = len(words)
        want[d, n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t or "")), dup, len(cover), n < 50 or 100 * len(cover) > 50 * n] += 1
    assert got == want


def test_quality_trees_learn_and_stay_monotone():
    rng = np.random.default_rng(0)
    x = rng.random((800, 2))
    y = ((x[:, 0] < 0.5) ^ (rng.random(800) < 0.1)).astype(float)
    trees = quality.boost(x, y, np.array([-1, 0]))
    assert ((trees.probability(x) > 0.5) == (x[:, 0] < 0.5)).mean() > 0.95
    line = np.stack([np.linspace(0, 1, 200), np.full(200, 0.3)], axis=1)
    assert (np.diff(trees.margin(line)) <= 1e-12).all()


def test_quality_on_held_out_labels(spark):
    d = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    trees = quality.fit(docs, labels.where("doc_id % 2 = 0"))
    held = quality.score(docs.join(labels.where("doc_id % 2 = 1"), "doc_id"), trees).select("quality", "quality_score").toPandas()
    hit = (held.quality_score >= 0.5) == (held.quality == 1)
    assert hit.mean() > max(held.quality.mean(), 1 - held.quality.mean())


def test_urls(spark, sf_dir):
    odd = [None, "", "http://", "no scheme.org/x", "HTTP://A.ORG", "x://example.org/en/12", "x://sub.Example.org/en/1", "x://fooexample.org/en/1", "x://a.com/b.org/", "x://com/fr/", "x://a.com/de/?q#f", "x://a.com?/de/", "x://spam.net/", "x://é.org/ü", "x://h.zip/a", "x://a.org/" + "y" * 3000]
    rows = [(r.page_id, r.url) for r in spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url").collect()] + [(-i, u) for i, u in enumerate(odd)]
    got = Counter(tuple(r) for r in urls.filter_urls(spark.createDataFrame(rows, "page_id long, url string")).collect())
    want = Counter()
    for p, u in rows:
        rest = (u or "").partition("://")[2]
        bare = re.match(r"[^?#]*", rest)[0]
        host, slash, tail = bare.partition("/")
        host, path = host.translate(AZ), slash + tail
        fit = [(len(h + q), h + q, v) for v, h, q in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(q)]
        bad = any(w in host + path for w in ("spam", "casino", "porn", "viagra")) or re.fullmatch(r"(?s)[^/]*\.zip/.*", host + path)
        want[p, host, path, max(fit)[1] if fit else None, max(fit)[2] if fit else "block" if bad else "allow"] += 1
    assert got == want


@pytest.mark.parametrize("text", ["", "</s>", "<\\s>", "<\\\\s>[INST]", "[\\/INST]\\", "<<s>s>", "a\n</s>\n<s>[INST]user\n", "[[INST]INST]"])
def test_escape_round_trip(text):
    safe = chat.escape(text)
    assert chat.unescape(safe) == text
    assert not any(c in safe for c in chat.CONTROLS)


def test_chat_windows(spark, sf_dir):
    turns = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    turns += [(-2, k, ["user", "assistant"][k % 2], f"word{k} " * 250) for k in range(9)] + [(-3, 0, "system", None), (-3, 1, None, "a%0A\nb"), (-3, 1, "assistant", "c"), (None, 0, "ro\nle%", "</s>\n<s>[INST]"), *queries.EXTRA_TURNS]
    frame = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    windows = chat.format_windows(frame, budget=1500, history=300)
    got = {r.conv_id: r for r in chat.read_back(windows).collect()}
    want = {}
    for c, k, role, text in sorted(turns, key=lambda t: (t[0] is None, t[0] or 0, t[1], t[2] or "", t[3] or "")):
        want.setdefault(c, []).append((role or "", text or ""))
    assert set(got) == set(want)
    for c, ts in want.items():
        loss = "".join(t for r, t in ts if r == "assistant")
        assert got[c].n_turns == len(ts)
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in ts).encode()).hexdigest()
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    sizes = windows.collect()
    assert any(r.window > 0 and r.n_context > 0 for r in sizes)
    assert all(r.n_tokens <= 1500 or r.n_new == 1 for r in sizes)
    assert sum(len(r.formatted) for r in sizes) == sum(r.formatted_chars for r in got.values())


def shares(sizes):
    """Targets of sizes in source order, by resharing until none is above its cap."""
    weights = [1 + i % 3 for i in range(len(sizes))]
    capped, total = set(), sum(sizes)
    while True:
        w = sum(weights[i] for i in range(len(sizes)) if i not in capped)
        left = total - sum(3 * sizes[i] for i in capped)
        target = [3.0 * s if i in capped else weights[i] * left / w for i, s in enumerate(sizes)]
        more = {i for i, s in enumerate(sizes) if i not in capped and target[i] > 3 * s}
        if not more:
            return target
        capped |= more


def test_mix(spark, sf_dir):
    given = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    rows = given + [(-1, None, None), (-2, "a b", None), (-3, "c", "tiny"), (-3, "c", "tiny"), (-4, "", "empty")] + [(10_000 + i, "w " * (i % 50), "hot") for i in range(3000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(frame, bucket_rows=100).collect()
    assert Counter((r.doc_id, r.source, r.size) for r in got) == Counter((d, s, len(re.findall(BLANK, t or ""))) for d, t, s in rows)
    totals = Counter()
    for d, t, s in rows:
        totals[s] += len(re.findall(BLANK, t or ""))
    order = sorted(totals, key=lambda s: (s is None, (s or "").encode()))
    target = dict(zip(order, shares([totals[s] for s in order])))
    for s in order:
        mine = [r for r in got if r.source == s]
        assert all(r.source_size == totals[s] and abs(r.target - target[s]) < 1e-6 and r.size * r.epochs <= r.taken <= 3 * r.size for r in mine)
        assert abs(sum(r.taken for r in mine) - target[s]) <= max(r.size for r in mine) / 2 + 1
    assert Counter(map(tuple, got)) == Counter(map(tuple, mixing.mix(frame.repartition(7)).collect()))


def test_empty_tables(spark):
    docs = frame(spark, []).selectExpr("*", "cast(null as string) as source", "1L as n_words")
    assert licenses.license_scan(docs).count() == mixing.mix(docs).count() == 0
    trees = quality.fit(docs, spark.createDataFrame([], "doc_id long, quality int"))
    assert quality.score(docs, trees).count() == 0
    assert urls.filter_urls(spark.createDataFrame([], "page_id long, url string")).count() == 0
    assert chat.read_back(chat.format_windows(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))).count() == 0


def test_history_keeps_turns_that_equal_the_system_turn(spark):
    rows = [(1, 0, "system", "be kind"), (1, 1, "system", "be kind"), (1, 2, "user", "one two three"), (1, 3, "assistant", "four five six")]
    got = chat.format_windows(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), budget=8, history=5).orderBy("window").collect()
    assert [r.n_new for r in got] == [3, 1] and chat.read_turns(got[1].formatted)[0] == ("system", "be kind")
    assert chat.read_turns(got[1].formatted)[1:3] == [("user", "one two three"), ("assistant", "four five six")]


def test_mix_buckets_are_even_at_any_weight(spark):
    """Weights of 0.1 alone, and beside others: the largest bucket stays under three times the mean."""
    for weights in ([0.1], [0.1, 1.1], [0.1, 0.12, 0.6, 1.0]):
        n, buckets = 40_000, 50
        w = F.element_at(F.array(*map(F.lit, weights)), (F.col("id") % len(weights) + 1).cast("int"))
        rows = spark.range(n).select(mixing.exponential_key(F.col("id"), F.lit(""), w, "s").alias("key"), w.alias("w"))
        counted = rows.groupBy((F.round(F.col("w") * mixing.WEIGHT_STEPS) / mixing.WEIGHT_STEPS).alias("w")).count().collect()
        plan = F.array(*(F.struct(F.lit(r.w).alias("w"), F.lit(r["count"]).alias("n")) for r in counted))
        dealt = rows.withColumns({"weights": plan, "n_docs": F.lit(n), "buckets": F.lit(buckets)}).groupBy(mixing.key_bucket().alias("b")).agg(F.count("*").alias("n"), F.min("key").alias("lo"), F.max("key").alias("hi")).orderBy("b").collect()
        assert max(r.n for r in dealt) < 3 * n / buckets and len(dealt) > 0.9 * buckets
        assert all(a.hi <= b.lo for a, b in zip(dealt, dealt[1:]))  # buckets are ranges of keys


def test_mix_whole_rows(spark):
    """Whole rows keep their columns, clashing names too; rows without a doc_id are spread by their text; a very long text is one size."""
    rows = [(None, f"word{i} " * 3, "s", 9) for i in range(50)] + [(1, None, "s", 9), (2, "", None, 9), (3, "x " * 200_000, "t", 9), (3, "x " * 200_000, "t", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, taken int").withColumns({"_id": F.lit("mine"), "key": F.lit("mine"), "weight": F.lit("mine")})
    got = mixing.mix(docs, whole=True, bucket_rows=5).collect()
    assert len(got) == len(rows) and all(r._id == r.key == r.weight == "mine" for r in got)
    assert Counter((r.doc_id, r.text, r.source) for r in got) == Counter(r[:3] for r in rows)
    assert Counter((r.doc_id, r.size, r.taken) for r in got) == Counter((r.doc_id, r.size, r.taken) for r in mixing.mix(docs).collect())
    keys = spark.createDataFrame(rows[:50], "doc_id long, text string, source string, k int").select(mixing.exponential_key(F.col("doc_id"), F.col("text"), F.lit(1.0), "s")).distinct()
    assert keys.count() == 50


def test_ties_of_templates_and_rules(spark):
    """Two templates that accept one place both give their labels; of two rules of one length the earlier wins."""
    docs = spark.createDataFrame([(1, "x one two three four y"), (1, "x one two three four y")], "doc_id long, text string")
    two = {"first": "one two three four", "second": "one two {{1}} four"}
    got = licenses.license_scan(docs, templates=two).collect()
    assert len(got) == 2 and all(set(r.labels.split(",")) >= {"first", "second"} for r in got)
    pages = spark.createDataFrame([(1, "http://a.net/x"), (1, "http://a.net/x"), (2, None)], "page_id long, url string").withColumns({"host": F.lit("mine"), "rule": F.lit("mine")})
    rules = (("block", "a.net", "/x"), ("allow", "a.net", "/x"))
    assert sorted((r.page_id, r.verdict) for r in urls.filter_urls(pages, rules=rules).collect()) == [(1, "block"), (1, "block"), (2, "allow")]


def test_very_long_inputs(spark):
    """A url of 200 000 bytes, a turn of 100 000 words, and a document of 300 000 words with a repeated row."""
    url = "http://www.example.org/es/" + "a/" * 100_000
    got = urls.filter_urls(spark.createDataFrame([(1, url), (2, "http://b.net/" + "x" * 100_000 + "spam")], "page_id long, url string")).collect()
    assert {r.page_id: (r.rule, r.verdict, len(r.path)) for r in got} == {1: ("example.org/es/", "block", 4 + 200_000), 2: (None, "block", 1 + 100_000 + 4)}
    turn = "word " * 100_000
    turns = spark.createDataFrame([(1, 0, "user", "hi"), (1, 1, "assistant", turn), (1, 2, "assistant", "short")], "conv_id long, turn long, role string, text string")
    back = chat.read_back(chat.format_windows(turns)).first()
    assert back.n_turns == 3 and back.loss_chars == len(turn) + 5
    docs = spark.createDataFrame([(1, "alpha beta\n" * 150_000), (2, "gamma " * 5), (2, "gamma " * 5)], "doc_id long, text string")
    trees = quality.fit(docs, spark.createDataFrame([], "doc_id long, quality int"))
    rows = sorted(tuple(r) for r in quality.score(docs, trees).select("doc_id", "n_words", "n_dup_lines", "base_failed").collect())
    assert rows == [(1, 300_000, 149_999, True), (2, 5, 0, True), (2, 5, 0, True)]


def test_trees_against_a_loop():
    """Scores of the flat node arrays equal a walk down each tree, node by node; a feature with a sign never steps against it."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 4))
    y = (x[:, 0] + x[:, 1] ** 2 > 0.5).astype(float)
    signs = np.array([1, 0, -1, 0])
    trees = quality.boost(x, y, signs, rounds=12)

    def walk(row):
        total = trees.bias
        for node in trees.roots:
            while trees.left[node] != node:
                node = trees.left[node] if row[trees.feature[node]] <= trees.threshold[node] else trees.right[node]
            total += trees.value[node]
        return total

    assert len(trees.roots) and np.allclose(trees.margin(x), [walk(r) for r in x], atol=1e-12)
    for j, sign in ((0, 1), (2, -1)):
        moved = x.copy()
        moved[:, j] += sign * rng.random(400)
        assert (trees.margin(moved) >= trees.margin(x) - 1e-12).all()

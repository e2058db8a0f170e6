import random
import re
import time
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from surveyflow.llm import common, edit, line_dedup, queries, simhash
from surveyflow.llm.components import components


def union(pairs):
    parent = {}

    def top(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = top(a), top(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {x: top(x) for x in list(parent)}


def test_components_against_union_find(spark):
    pick = random.Random(5)
    pairs = [(pick.randint(0, 300), pick.randint(0, 300)) for _ in range(200)] + [(i, i + 1) for i in range(1000, 1060)]
    pairs += [(500, i) for i in range(501, 700)] + [(7, 7)]
    found = {r.node: r.component for r in components(spark.createDataFrame([*pairs, (None, 3)], "a long, b long")).collect()}
    want = {x: r for x, r in union([p for p in pairs if p[0] != p[1]]).items() if x != r}
    assert found == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.text("abé😀", max_size=24), st.text("abé😀", max_size=24)), min_size=1, max_size=20), st.integers(0, 7))
def test_edit_distance(pairs, most):
    pairs = [tuple(sorted(p, key=len)) for p in pairs]
    (a, n), (b, m) = (edit.code_points([p[k] for p in pairs]) for k in (0, 1))
    assert edit.within(a, n, b, m, most).tolist() == [distance(x, y) <= most for x, y in pairs]


def test_edit_distance_has_a_bound():
    with pytest.raises(ValueError, match="7 edits"):
        edit.within(*[np.zeros((0, 0), "i4"), np.zeros(0, "i4")] * 2, 8)


def rule(n):
    """Edits between two lines the shorter one of which has n characters."""
    return 0 if n < 16 else 1 if n < 32 else max(2, n // 50)


def at_most(a, b, most):
    """Whether ``b``, the longer, is within ``most`` edits of ``a``: the plain table, as far as the diagonals allow."""
    start = next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    a, b = a[start:], b[start:]
    end = next((k for k, (x, y) in enumerate(zip(a[::-1], b[::-1], strict=False)) if x != y), len(a))
    a, b = a[: len(a) - end], b[: len(b) - end]
    far = most + 1
    row = {j: j for j in range(min(len(b), most) + 1)}
    for i, x in enumerate(a, 1):
        now = {}
        for j in range(max(0, i - most), min(len(b), i + most) + 1):
            best = min(row.get(j, far), now.get(j - 1, far)) + 1
            if j:
                best = min(best, row.get(j - 1, far) + (x != b[j - 1]))
            now[j] = i if j == 0 else best
        row = now
    return row.get(len(b), far) <= most


def linked_pairs(distinct):
    """All linked pairs by the rule; letters that one line has more of than the other rule most out beforehand."""
    distinct = sorted(distinct, key=lambda x: (len(x), x))
    sizes = np.array([len(x) for x in distinct])
    letters = sorted({c for x in distinct for c in x})
    bags = np.zeros((len(distinct), len(letters)), "i4")
    for i, x in enumerate(distinct):
        for c in set(x):
            bags[i, letters.index(c)] = x.count(c)
    pairs = []
    for i, a in enumerate(distinct):
        most = rule(len(a))
        end = int(np.searchsorted(sizes, len(a) + most, side="right"))
        if most and end > i + 1:
            more = np.maximum(bags[i + 1 : end] - bags[i], 0).sum(1)
            pairs += [(a, distinct[i + 1 + k]) for k in np.flatnonzero(more <= most).tolist() if at_most(a, distinct[i + 1 + k], most)]
    return pairs


def test_the_tests_own_distance():
    pick = random.Random(8)
    for _ in range(300):
        a, b = sorted(("".join(pick.choice("ab") for _ in range(pick.randint(0, 12))) for _ in range(2)), key=len)
        most = pick.randint(max(0, len(b) - len(a)), 8 + len(b) - len(a))
        assert at_most(a, b, most) == (distance(a, b) <= most)


def brute_lines(rows):
    occurrences = []
    for i, text in rows:
        for n, line in enumerate((text or "").split("\n") if text is not None else []):
            line = line.strip(" \t\n\x0b\x0c\r")
            if line:
                occurrences.append((i, n, line))
    pairs = linked_pairs({line for _, _, line in occurrences})
    class_of, links = union(pairs), {}
    for a, b in pairs:
        links[a], links[b] = links.get(a, 0) + 1, links.get(b, 0) + 1
    first = {}
    order = sorted(occurrences, key=lambda o: (o[0] is not None, o[0] or 0, o[1]))
    for i, n, line in order:
        first.setdefault(class_of.get(line, line), (i, n))
    return sorted(
        (str(i), n, str(first[class_of.get(line, line)][0]), first[class_of.get(line, line)][1], links.get(line, 0), first[class_of.get(line, line)] == (i, n))
        for i, n, line in occurrences
    )


def variants(seed, base, n, most=3):
    pick = random.Random(seed)
    for _ in range(n):
        text = list(base)
        for _ in range(pick.randint(0, most)):
            at = pick.randrange(len(text))
            text[at : at + pick.randint(0, 1)] = pick.choice(["", "q", "é"])
        yield "".join(text)


def line_rows():
    base = ["the quick brown fox jumps over the lazy dog", "abababababababababababababababababab", "in the beginning there was a rather long line of words, é"]
    rows = []
    for k, line in enumerate(base):
        rows += [(100 * k + i, f"{v}\nshort\n\n  {line} \nline {i} of its own, number {i * i * 7919}") for i, v in enumerate(variants(k, line, 40))]
    return rows


def found_lines(frame):
    return sorted((str(r.doc_id), r.line_no, str(r.class_doc_id), r.class_line_no, r.n_links, r.kept) for r in frame.collect())


def test_line_dedup_against_brute_force(spark):
    rows = line_rows()
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert found_lines(line_dedup.near_duplicates(frame)) == brute_lines(rows)


def test_line_groups_in_parts_lose_no_link(spark):
    rows = line_rows()
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    def totals(part):
        found = line_dedup.links(frame, part=part).collect()
        counts = {}
        for r in found:
            if r.b is None:
                counts[bytes(r.a)] = counts.get(bytes(r.a), 0) + r.n
        return counts, union([(bytes(r.a), bytes(r.b)) for r in found if r.b is not None])

    assert totals(3) == totals(256)


def test_line_dedup_of_odd_rows(odd, nothing, odd_rows):
    assert found_lines(line_dedup.near_duplicates(odd)) == brute_lines(odd_rows)
    assert line_dedup.near_duplicates(nothing).count() == 0
    verdict = line_dedup.near_duplicates(odd)
    left = line_dedup.drop_lines(odd, verdict)
    assert left.columns == odd.columns
    texts = {r.doc_id: r.text for r in left.collect()}
    assert 1 not in texts and 2 not in texts and 3 not in texts  # no words
    assert texts[4] == "hello world" and 5 not in texts  # the later equal line goes, and its document with it
    assert texts[9] == "hello   world  "  # the first of two equal lines stays, as it was
    assert texts[8] == dict(odd_rows)[8]
    assert line_dedup.drop_lines(nothing, line_dedup.near_duplicates(nothing)).count() == 0


def test_line_dedup_query(spark, sf, corpus):
    # The whole table by plain comparison of all lines of like lengths.
    want = brute_lines([(i, r.text) for i, r in corpus.items()])
    got = found_lines(queries.op1_line_dedup(spark, sf))
    assert got == want
    lengths = {(i, n): len(corpus[int(i)].text.split("\n")[n].strip()) for i, n, *_ in want}
    far = [r for r in want if r[4] and lengths[r[:2]] >= 150]
    assert len(far) >= 10  # the rule by length is at work on the table


def brute_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hashed = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashed) > len(hashed))


def brute_components(prints):
    ids = sorted(prints)
    values = np.array([prints[i] for i in ids], "u8")
    near = np.bitwise_count(values[:, None] ^ values[None, :]) <= 4
    tops = union([(ids[a], ids[b]) for a, b in zip(*np.nonzero(near), strict=True)])
    return {i: tops[i] for i in ids}


def test_simhash_query(spark, sf, corpus):
    prints = {i: brute_print(r.text) for i, r in corpus.items()}
    want = brute_components(prints)
    rows = queries.op7_simhash(spark, sf).collect()
    assert len(rows) == len(corpus)
    for r in rows:
        assert r.fingerprint == f"{prints[r.doc_id]:016x}" and r.component_id == want[r.doc_id]


@settings(max_examples=30, deadline=None)
@given(st.integers(0, 10**6), st.integers(0, 4))
def test_bit_planes_against_popcount(seed, radius):
    pick = np.random.default_rng(seed)
    n = int(pick.integers(1, 300))
    group = np.sort(pick.integers(0, 6, n))
    prints = pick.integers(0, 1 << 63, 4, dtype="u8")[pick.integers(0, 4, n)]
    for _ in range(4):
        prints ^= np.where(pick.random(n) < 0.7, np.uint64(1) << pick.integers(0, 64, n, dtype="u8"), np.uint64(0))
    near = (np.bitwise_count(prints[:, None] ^ prints[None, :]) <= radius) & (group[:, None] == group[None, :])
    want = union(list(zip(*(x.tolist() for x in np.nonzero(near)), strict=True)))
    assert simhash.link_groups(group, prints, radius).tolist() == [want[i] for i in range(n)]


def test_every_close_pair_shares_a_key():
    import itertools

    edges = np.cumsum((0, *simhash.BLOCKS))
    assert edges[-1] == 64
    for hit in itertools.combinations(range(6), 4):
        assert len(set(range(6)) - set(hit)) >= 2


def test_simhash_in_parts(spark):
    pick = np.random.default_rng(3)
    base = int(pick.integers(0, 1 << 62))
    values = sorted({base ^ (1 << int(a)) ^ (1 << int(b)) for a, b in pick.integers(0, 60, (200, 2))})
    frame = spark.createDataFrame([(v,) for v in values], "fingerprint long")
    for part in (16, 4096):
        tied = union([(r.a, r.b) for r in simhash.links(frame, part=part).collect()])
        assert len({tied[v] for v in values}) == 1


def test_simhash_of_odd_rows(odd, nothing):
    rows = simhash.near_duplicates(odd).collect()
    zero = {r.component_id for r in rows if r.fingerprint == "0" * 16}
    assert zero == {1} and len(rows) == odd.count()
    assert {r.component_id for r in rows if r.doc_id in (4, 5)} == {4}
    assert simhash.near_duplicates(nothing).count() == 0
    kept = simhash.keep_first(odd)
    assert kept.columns == odd.columns
    ids = sorted(str(r.doc_id) for r in kept.collect())
    assert ids == ["1", "4", "6", "7", "8", "9", "None"]
    assert simhash.keep_first(nothing).count() == 0


def test_line_verdicts_belong_to_rows(spark):
    rows = [
        (None, "first of one\nsecond of one"),
        (None, "alone in two\nfirst of one"),
        (None, "alone in three\nalso in three"),
        (1, "words of a\nmore of a"),
        (1, "words of b\nmore of a"),
        (1, "words of c\nlast of c"),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    left = line_dedup.drop_lines(frame, line_dedup.near_duplicates(frame)).collect()
    texts = sorted(r.text for r in left)
    assert sorted(x for t in texts for x in t.split("\n")) == sorted({x for _, t in rows for x in t.split("\n")})
    assert {rows[2][1], rows[5][1]} <= set(texts) and len(texts) == 6


def test_one_row_of_each_component_stays(spark):
    one, two, three = ("first words alone here", "quite another text it is", "zebra yak xenon walrus")
    rows = [(5, one), (5, two), (7, two), (None, three), (None, three), (None, one), (8, one), (9, None), (None, "")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    for parts in (1, 5):
        kept = simhash.keep_first(frame.repartition(parts)).collect()
        assert sorted(kept, key=str) == sorted([(5, one), (5, two), (None, three), (9, None)], key=str)


def test_wide_band():
    pick = random.Random(3)
    for most in (0, 1, 7, 9, 40):
        for _ in range(40):
            a = "".join(pick.choice("abcé😀") for _ in range(pick.randint(1, 160)))
            b = list(a)
            for _ in range(pick.randint(0, most + 3)):
                at = pick.randrange(len(b) + 1)
                b[at : at + pick.randint(0, 1)] = pick.choice(["", "q", "é"])
            x, y = sorted([a, "".join(b)], key=len)
            assert edit.within_wide(x, y, most) == (distance(x, y) <= most)


@pytest.mark.parametrize("few", [0, 3, 32])
def test_diagonals_and_band_agree_with_plain_distance(monkeypatch, few):
    monkeypatch.setattr(edit, "FEW", few)
    pick, told = random.Random(5), set()
    for n in (0, 1, 2, 3, 9, 16, 17, 33, 80) * 40:
        a = "".join(pick.choice("abé") for _ in range(n))
        b = list(a)
        for _ in range(pick.randint(0, 9)):
            at = pick.randrange(len(b) + 1)
            b[at : at + pick.randint(0, 1)] = pick.choice(["", "a", "q"])
        x, y = sorted([a, "".join(b)], key=len)
        most = pick.randint(0, 12)
        close = distance(x, y) <= most
        told.add(close)
        assert edit.within_wide(x, y, most) == close
    assert told == {False, True}


def test_nearly_equal_long_lines_take_no_band():
    # A mask of the whole line for every character would be several times this much.
    pick = random.Random(6)
    a = "".join(pick.choice("abcdefghijklmnopqrstuvwxyz0123456789") for _ in range(60_000))
    b = a[:1000] + "é" + a[1001:30_000] + a[30_001:] + "qq"
    tracemalloc.start()
    try:
        assert edit.within_wide(a, b, 1200)
        assert tracemalloc.get_traced_memory()[1] < 1 << 20
    finally:
        tracemalloc.stop()


def test_a_pair_comes_under_the_least_key_of_both():
    pick = random.Random(7)
    strings = [f"{'x' * 200}{i:03}" for i in range(40)]
    own = [sorted({pick.randrange(12) for _ in range(pick.randint(1, 5))}) for _ in strings]
    rows = [{"key": k, "p": 0, "q": 0, "own": 0, "keys": own[i], "i": i} for k in range(12) for i in range(40) if k in own[i]]
    rows, number = pa.Table.from_pylist(rows), np.array([r["i"] for r in rows])
    found = line_dedup._long_candidates(rows, number, np.full(40, 203), strings, 2, 32)
    pairs = sorted(pair for _, a, b in found for pair in zip(a.tolist(), b.tolist(), strict=True))
    assert pairs == [(i, j) for i in range(40) for j in range(i + 1, 40) if set(own[i]) & set(own[j])]


def test_common_lines_and_keys_that_others_hold(spark, monkeypatch):
    # Copies of a long line, each with an edit of its own: their keys' lines are subsets of others'. All keys count as common.
    pick = random.Random(4)
    word = lambda: "".join(pick.choice("abcdefghij") for _ in range(pick.randint(2, 9)))
    base = [" ".join(word() for _ in range(n)) for n in (8, 45, 130)]
    rows = [(i, "\n".join(variants(i, b, 1, 4).__next__() for b in base)) for i in range(60)]
    rows += [(100 + i, base[1] + " " + " ".join(word() for _ in range(40))) for i in range(10)]  # passages shared by unlike lines
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute_lines(rows)
    assert found_lines(line_dedup.near_duplicates(frame)) == want
    monkeypatch.setattr(line_dedup, "SAMPLED", 1)
    monkeypatch.setattr(line_dedup, "COMMON", 2)
    assert found_lines(line_dedup.near_duplicates(frame.repartition(7))) == want


def test_runs_hold_for_every_length():
    for n in range(150, 6000):
        number = int(np.searchsorted(line_dedup.CLASSES, n, side="right"))
        edits = rule(n)
        assert line_dedup.RUNS[number] <= -(-(n - edits) // (edits + 1))
        for longer in range(edits + 1):  # the longer line is in the shorter one's class too
            m = n + longer
            low, high = (int(np.searchsorted(line_dedup.CLASSES, x, side="right")) for x in (m - m // line_dedup.SHARE, m))
            assert number in (low, high)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("abcdé😀 ", max_size=30), min_size=2, max_size=12), st.integers(0, 6))
def test_bags_rule_out_no_close_pair(strings, most):
    strings = sorted(strings, key=len)
    a, b = np.triu_indices(len(strings), 1)
    alike = line_dedup._alike(line_dedup._bags(strings), a, b, np.full(len(strings), most))
    for x, y, good in zip(a.tolist(), b.tolist(), alike.tolist(), strict=True):
        assert good or distance(strings[x], strings[y]) > most


def test_edits_grow_with_length(spark):
    pick, rows = random.Random(9), []
    for k, size in enumerate((12, 17, 31, 90, 149, 151, 186, 240, 700)):
        base = "".join(pick.choice("abcdefgh ") for _ in range(size - 2)).join("xx")
        most = line_dedup.allowed(size)
        for n in range(5):
            some = list(base)
            for place in range(most + (n == 4)):  # evenly spread, as far apart as can be
                at = (place + 1) * size // (most + 2)
                some[at : at + (n != 1)] = "é" + str(n) * (n > 1 and place % 2)
            rows.append((10 * k + n, "".join(some)))
        rows.append((10 * k + 9, base))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    distinct = sorted({line.strip() for _, line in rows}, key=lambda x: (len(x), x))
    links = {x: 0 for x in distinct}
    for i, a in enumerate(distinct):
        for b in distinct[i + 1 :]:
            most = line_dedup.allowed(len(a))
            if len(b) - len(a) <= most and distance(a, b) <= most:
                links[a] += 1
                links[b] += 1
    found = {r.doc_id: r.n_links for r in line_dedup.near_duplicates(frame).collect()}
    assert found == {i: links[x.strip()] for i, x in rows}
    assert all(any(found[10 * k + n] for n in range(5)) for k in range(1, 9))


def test_long_lines_verified_in_turns_lose_no_link(spark, monkeypatch):
    """Texts go to their keys in turns that move about as many bytes as the texts have: links are those of one turn."""
    pick = random.Random(6)
    base = ["".join(pick.choice("abcdefgh ") for _ in range(size)) for size in (400, 900)]
    rows = [(100 * k + i, v) for k, b in enumerate(base) for i, v in enumerate(variants(k, b, 12, 5))]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    want = found_lines(line_dedup.near_duplicates(frame))
    monkeypatch.setattr(line_dedup, "_turns", lambda *_: 3)
    assert found_lines(line_dedup.near_duplicates(frame)) == want == brute_lines(rows)


def test_turns_follow_from_what_is_moved(spark, monkeypatch):
    texts = spark.createDataFrame([(1, "x" * 76, [(1, 5), (2, 300), (3, 1)])], "h long, line string, own_keys array<struct<key: long, n: long>>")
    assert line_dedup._turns(texts, 256) == 1
    monkeypatch.setattr(line_dedup, "TURN_BYTES", 1)
    assert line_dedup._turns(texts, 256) == 4  # the key of 300 lines is dealt out in two parts
    assert line_dedup._turns(texts.limit(0), 256) == 1


def test_stored_tables_leave_no_shuffle_files(spark):
    def files():
        found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        names = [found.apply(i).getName() for i in range(found.size())]
        return {name for name in names if name.startswith("shuffle_")}

    before, setting = files(), spark.conf.get(common.FILE_CLEANUP, None)
    kept = common.stored(spark.range(1000).repartition(4, "id"), "some")
    assert kept.count() == 1000
    until = time.time() + 20
    while files() - before and time.time() < until:  # they are removed beside the driver's work
        time.sleep(0.1)
    assert not files() - before
    assert spark.conf.get(common.FILE_CLEANUP, None) == setting

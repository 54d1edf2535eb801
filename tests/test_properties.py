"""Property tests: operators against small Python models on random inputs."""

from __future__ import annotations

import datetime as dt
from collections import Counter, defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tallyloom.functions import suffix_branch_predicate, suffix_tag
from tallyloom.operators import cogroup, group_values, sum_per_key, words
from tallyloom.plans import word_count_text
from tallyloom.sources import from_rows
from tallyloom.streaming import tumbling_sum

SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))


def java_split_space(s: str) -> list[str]:
    """Model of Java's ``s.split(" ")``: trailing empty pieces removed."""
    if " " not in s:
        return [s]
    parts = s.split(" ")
    while parts and parts[-1] == "":
        parts.pop()
    return parts


lines_st = st.lists(st.one_of(st.none(), st.text(alphabet="ab \t", max_size=10)), max_size=25)


@SETTINGS
@given(lines=lines_st)
def test_words_match_java_split(spark, lines):
    df = from_rows(spark, list(enumerate(lines)), "id int, line string")
    got = defaultdict(Counter)
    for r in words(df, keep=["id"]).collect():
        got[r.id][r.word] += 1
    for i, line in enumerate(lines):
        expected = Counter(java_split_space(line)) if line is not None else Counter()
        assert got.get(i, Counter()) == expected, (line, got.get(i))


pairs_st = st.lists(
    st.tuples(st.sampled_from(["h", "h", "h", "x", "y", None]), st.one_of(st.none(), st.integers(0, 4))),
    max_size=60,
)


@SETTINGS
@given(pairs=pairs_st, chunk=st.integers(1, 7), distinct=st.booleans())
def test_group_values_matches_python(spark, pairs, chunk, distinct):
    df = from_rows(spark, pairs, "key string, value int")
    expected = defaultdict(Counter)
    for k, v in pairs:
        expected[k]  # every key appears, even with only null values
        if v is not None:
            expected[k][v] += 1
    got = defaultdict(Counter)
    for r in group_values(df, chunk_size=chunk, distinct_values=distinct).collect():
        got[r.key].update(r["values"])
        assert len(r["values"]) <= chunk
    assert got == expected


@SETTINGS
@given(a=pairs_st, b=pairs_st, chunk=st.integers(1, 5), distinct=st.booleans())
def test_cogroup_matches_python(spark, a, b, chunk, distinct):
    fa = from_rows(spark, a, "key string, value int")
    fb = from_rows(spark, b, "key string, value int")
    expected: dict = {}
    for tag, items in (("a", a), ("b", b)):
        for k, v in items:
            expected.setdefault(k, {"a": Counter(), "b": Counter()})
            if v is not None:
                expected[k][tag][v] += 1
    got: dict = {}
    for r in cogroup({"a": fa, "b": fb}, chunk_size=chunk, distinct_values=distinct).collect():
        entry = got.setdefault(r.key, {"a": Counter(), "b": Counter()})
        assert len(r.a) + len(r.b) <= chunk
        entry["a"].update(r.a)
        entry["b"].update(r.b)
    assert got == expected


@SETTINGS
@given(values=st.lists(st.one_of(st.none(), st.text(alphabet="abx", max_size=4)), max_size=20))
def test_suffix_tag_matches_python(spark, values):
    rules = [("x", "X"), ("ax", "AX"), ("b", "B")]
    df = from_rows(spark, list(enumerate(values)), "id int, v string")
    got = {r.id: r.tag for r in df.select("id", suffix_tag("v", rules, "D").alias("tag")).collect()}
    for i, v in enumerate(values):
        want = next((t for s, t in rules if v is not None and v.endswith(s)), "D")
        assert got[i] == want


@SETTINGS
@given(
    values=st.lists(st.one_of(st.none(), st.text(alphabet="abx", max_size=4)), max_size=20),
    rules=st.lists(st.tuples(st.text(alphabet="abx", max_size=2), st.sampled_from(["P", "Q", "D"])), max_size=4),
)
def test_branch_predicates_partition_like_tags(spark, values, rules):
    df = from_rows(spark, list(enumerate(values)), "id int, v string")
    tags = {r.id: r.tag for r in df.select("id", suffix_tag("v", rules, "D").alias("tag")).collect()}
    for tag in sorted({t for _, t in rules} | {"D"}):
        ids = {r.id for r in df.filter(suffix_branch_predicate("v", rules, "D", tag)).collect()}
        assert ids == {i for i, t in tags.items() if t == tag}, (tag, rules, values)


texts_st = st.lists(st.one_of(st.none(), st.text(alphabet="ab \n\r", max_size=14)), max_size=15)


def python_lines(text: str) -> list[str]:
    """Lines of a text value split at \\r\\n, \\r or \\n (all pieces kept)."""
    return text.replace("\r\n", "\n").replace("\r", "\n").split("\n")


@SETTINGS
@given(texts=texts_st)
def test_word_count_text_matches_python(spark, texts):
    df = from_rows(spark, texts, "text string")
    expected = Counter()
    for t in texts:
        if t is not None:
            for line in python_lines(t):
                if line and set(line) == {" "}:
                    continue
                expected.update(java_split_space(line))
    assert {r.word: r.n for r in word_count_text(df).collect()} == dict(expected)


@SETTINGS
@given(items=st.lists(st.tuples(st.integers(0, 40), st.integers(-5, 5)), max_size=30))
def test_tumbling_sum_matches_python(spark, items):
    base = dt.datetime(2024, 1, 1)
    df = from_rows(spark, [(base + dt.timedelta(seconds=s), v) for s, v in items], "ts timestamp_ntz, value int")
    expected = Counter()
    for s, v in items:
        expected[s // 5 * 5] += v
    got = {int((r.w_start - base).total_seconds()): r.s for r in tumbling_sum(df).collect()}
    assert got == dict(expected)
    assert all((r.w_end - r.w_start).total_seconds() == 5 for r in tumbling_sum(df).collect())


@SETTINGS
@given(items=st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(-3, 3)), max_size=30))
def test_sum_per_key_matches_python(spark, items):
    df = from_rows(spark, items, "key string, value int")
    expected = Counter()
    for k, v in items:
        expected[k] += v * 10
    assert {r.key: r.value for r in sum_per_key(df, factor=10).collect()} == {k: expected[k] for k, _ in items}

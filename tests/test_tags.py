import random

from hypothesis import given, settings
from hypothesis import strategies as st

from quarry.operators import tags as TG


def brute_force(s, words):
    """The segmentation rule written directly from its definition."""
    if s is None or s == "":
        return None
    ws = sorted({w for w in words if w}, key=len, reverse=True)

    def forward():
        i, out = 0, []
        while i < len(s):
            m = next((w for w in ws if s.startswith(w, i)), None)
            if m is None:
                return None
            out.append(m)
            i += len(m)
        return out

    def reverse():
        j, out = len(s), []
        while j > 0:
            m = next((w for w in ws if len(w) <= j and s[j - len(w):j] == w), None)
            if m is None:
                return None
            out.insert(0, m)
            j -= len(m)
        return out

    r = forward() or reverse()
    return "|".join(r) if r else None


def _run(spark, strings, words, distributed=False, on_fail="null"):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(strings)], "id int, tags string")
    tags = spark.createDataFrame([(w,) for w in words], "tag_name string")
    fn = TG.segment_distributed if distributed else TG.segment
    got = {r["id"]: r["split_tags"] for r in fn(df, tags, on_fail=on_fail).collect()}
    return [got.get(i) for i in range(len(strings))]


def test_fixture_cases(spark):
    words = ["javascript", "jquery", "java", "c", "c#"]
    strings = ["javascriptjquery", "javac#", "xyz", None]
    assert _run(spark, strings, words) == ["javascript|jquery", "java|c#", None, None]
    assert _run(spark, strings, words, distributed=True) == ["javascript|jquery", "java|c#", None, None]


def test_drop_and_sentinel(spark):
    words = ["javascript", "jquery", "java", "c", "c#"]
    strings = ["javascriptjquery", "xyz", None]
    assert _run(spark, strings, words, on_fail="drop") == ["javascript|jquery", None, None]
    assert _run(spark, strings, words, on_fail="sentinel") == ["javascript|jquery", "*****", "*****"]


def test_reverse_only_and_forward_first(spark):
    assert _run(spark, ["abcd"], ["ab", "abc", "cd"]) == ["ab|cd"]
    assert _run(spark, ["abcd"], ["ab", "bc", "abc", "cd", "d", "a"]) == ["abc|d"]
    assert _run(spark, ["abcd"], ["ab", "abc", "cd"], distributed=True) == ["ab|cd"]


def test_regex_special_characters(spark):
    words = ["c++", ".net", "c#", "a.b", "(x)", "[y]"]
    strings = ["c++.net", "c#a.b", "(x)[y]", "cc++"]
    assert _run(spark, strings, words) == [brute_force(s, words) for s in strings]


def test_oversize_dictionary_falls_back(spark):
    df = spark.createDataFrame([(1, "javac#")], "id int, tags string")
    tags = spark.createDataFrame([(w,) for w in ["java", "c#", "c"]], "tag_name string")
    got = TG.segment(df, tags, max_chars=2).collect()
    assert got[0]["split_tags"] == "java|c#"


@settings(max_examples=5, deadline=None)
@given(st.integers(min_value=0, max_value=10_000))
def test_random_dictionaries_match_brute_force(spark, seed):
    rng = random.Random(seed)
    alphabet = "abc"
    words = list({"".join(rng.choice(alphabet) for _ in range(rng.randint(1, 4))) for _ in range(8)})
    strings = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 12))) for _ in range(40)]
    expected = [brute_force(s, words) for s in strings]
    assert _run(spark, strings, words) == expected
    assert _run(spark, strings, words, distributed=True) == expected


def test_prefix_matches(spark):
    df = spark.createDataFrame([(1, "javascriptjquery"), (2, "c#x"), (3, "")], "id int, tags string")
    words = ["javascript", "java", "j", "c", "c#", "jquery"]
    tags = spark.createDataFrame([(w,) for w in words], "tag_name string")
    want = sorted([(1, "javascript"), (1, "java"), (1, "j"), (2, "c"), (2, "c#")])
    got = sorted((r["id"], r["tag_name"]) for r in TG.prefix_matches(df, tags).collect())
    assert got == want


def test_pass_column_on_either_path_and_long_tags(spark):
    from quarry.operators import tags as TG
    tags = spark.createDataFrame([("ab",), ("abc",), ("cd",), ("x" * 5000,)], "tag_name string")
    df = spark.createDataFrame([(1, "abab"), (2, "abcd"), (3, "zz"), (4, "x" * 5000 + "ab"), (5, "")], "id long, tags string")
    regex, joined = (TG.segment(df, tags, on_fail="null", with_pass=True, max_chars=n) for n in (10 ** 6, 1))
    assert regex.columns == joined.columns
    want = [(1, "ab|ab", "forward"), (2, "ab|cd", "reverse"), (3, None, None),
            (4, "x" * 5000 + "|ab", "forward"), (5, None, None)]
    for got in (regex, joined):
        assert sorted((r["id"], r["split_tags"], r["pass"]) for r in got.collect()) == want


def test_prefix_matches_have_one_plan_at_every_size(spark):
    from quarry.operators import tags as TG
    for n in (3, 400):
        words = [f"t{i}" for i in range(n)]
        df = spark.createDataFrame([(1, "t12x"), (2, None), (3, "q")], "id long, tags string")
        got = TG.prefix_matches(df, spark.createDataFrame([(w,) for w in words], "tag_name string"))
        assert sorted(r["tag_name"] for r in got.collect()) == sorted(w for w in words if "t12x".startswith(w))


def test_trie_matches_brute_force():
    import pyarrow as pa

    from quarry.functions import trie as TR
    r = random.Random(1)
    for _ in range(150):
        alphabet = "abé中"[:r.randint(2, 4)]
        words = ["".join(r.choice(alphabet) for _ in range(r.randint(0, 5))) for _ in range(r.randint(0, 30))]
        strings = ["".join(r.choice(alphabet + "x") for _ in range(r.randint(0, 9))) for _ in range(50)] + [None]
        forward = TR.build([w.encode() for w in words])
        backward = TR.build([w.encode()[::-1] for w in words])
        pieces, how = TR.segment(pa.array(strings, pa.string()), forward, backward)
        got = ["|".join(p) if p else None for p in pieces.to_pylist()]
        assert got == [brute_force(s, words) for s in strings]
        assert [h is None for h in how.to_pylist()] == [g is None for g in got]


def test_three_paths_agree_beyond_the_regex_bound(spark):
    r = random.Random(2)
    words = list({"".join(r.choice("abcdefghijklmnopqrstuvwxyz-.é") for _ in range(r.randint(3, 30)))
                  for _ in range(270_000)})
    assert sum(map(len, words)) > TG.MAX_DICTIONARY_CHARS
    strings = ["".join(r.choice(words) for _ in range(r.randint(1, 5))) + r.choice(["", "", "#"]) for _ in range(60)]
    strings += ["", None, "x" * 20_000, words[0] * 3000]
    df = spark.createDataFrame(list(enumerate(strings)), "id long, tags string")
    tags = spark.createDataFrame([(w,) for w in words], "tag_name string")
    answer = lambda d: sorted((x["id"], x["split_tags"], x["pass"]) for x in d.collect())
    chosen = TG.segment(df, tags, on_fail="null", with_pass=True)
    assert "PythonUDF" in chosen._jdf.queryExecution().toString() or "Arrow" in chosen._jdf.queryExecution().toString()
    some = df.where("length(tags) < 1000 OR tags IS NULL")
    assert answer(chosen.where("length(tags) < 1000 OR tags IS NULL")) == answer(
        TG.segment_distributed(some, tags, on_fail="null", with_pass=True))
    long = {x["id"]: x["split_tags"] for x in chosen.where("length(tags) >= 1000").collect()}
    assert long[strings.index(words[0] * 3000)].replace("|", "") == words[0] * 3000
    empty = spark.createDataFrame([], "tag_name string")
    assert TG.segment_trie(df, empty).count() == 0
    assert TG.segment_trie(df, tags, passes="forward", as_array=True).count() > 20


def test_prefix_merge_matches_brute_force(spark):
    from collections import Counter
    r = random.Random(3)
    words = list({"".join(r.choice("abé") for _ in range(r.randint(1, 7))) for _ in range(200)}) + ["", None]
    strings = ["".join(r.choice("abéz") for _ in range(r.randint(0, 10))) for _ in range(600)]
    strings += ["abababab"] * 400 + [None]  # one string in many rows covers several ranges
    df = spark.createDataFrame([(i, s, "x") for i, s in enumerate(strings)], "id long, tags string, part string").repartition(5)
    tags = spark.createDataFrame([(w,) for w in words], "tag_name string").repartition(3)
    want = Counter((i, s, w) for i, s in enumerate(strings) if s for w in words if w and s.startswith(w))
    for got in (TG.prefix_merge(df, tags), TG.prefix_matches(df, tags, max_chars=10)):
        assert got.columns == ["id", "tags", "part", "tag_name"]
        assert Counter((x["id"], x["tags"], x["tag_name"]) for x in got.collect()) == want
    assert TG.prefix_merge(df.where("false"), tags).count() == 0
    assert TG.prefix_merge(df, tags.where("false")).count() == 0


def test_prefix_merge_moves_strings_and_tags_once(spark):
    """Rows written by the one shuffle: strings, tags and a few tags more."""
    r = random.Random(4)
    words = ["a" * k for k in range(1, 6)] + ["".join(r.choice("abc") for _ in range(6)) for _ in range(100)]
    strings = ["".join(r.choice("abc") for _ in range(9)) for _ in range(900)]
    df = spark.createDataFrame(list(enumerate(strings)), "id long, tags string")
    got = TG.prefix_merge(df, spark.createDataFrame([(w,) for w in words], "tag_name string"))
    got.write.format("noop").mode("overwrite").save()
    plan = got._jdf.queryExecution().executedPlan().toString()
    # the merge's own exchange, and the distinct of the dictionary
    assert plan.split("Initial Plan")[0].count("Exchange hashpartitioning(part") == 1
    assert "Join" not in plan

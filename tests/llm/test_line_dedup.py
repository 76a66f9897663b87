import random
import re
from collections import defaultdict

import pytest
from corpus import SF_DIR, documents
from pyspark.sql import functions as F

from lotwise.llm import line_dedup
from lotwise.llm.line_dedup import dedup_lines


def cleaned(spark, texts, **kinds):
    return {r["doc_id"]: r["clean_text"] for r in dedup_lines(documents(spark, texts), **kinds).collect()}


SPACES = " \t\x0b\x0c\r"


def by_definition(texts, depth=3, min_docs=2):
    """What is left of every text, by the rule: ``texts`` maps identifiers to texts."""
    lines = {i: (t or "").split("\n") for i, t in texts.items()}
    mask = {}
    for own in lines.values():
        for line in own:
            words = re.split(f"[{SPACES}]+", line.strip(SPACES))
            mask[line] = [re.sub(r".*[0-9].*", "<*>", w, flags=re.S) for w in words]
    holders = defaultdict(set)
    for i, own in lines.items():
        for line in own:
            if line.strip(SPACES):
                holders[tuple(mask[line])].add(i)
    leaves = defaultdict(list)
    for words in holders:
        leaves[len(words), words[:depth]].append(words)
    template = {}
    open_parts = [part for part in leaves.values() if len(part) > 1]
    while open_parts:
        part = open_parts.pop()
        heard, n = sum(len(holders[w]) for w in part), len(part[0])
        votes, have = defaultdict(int), defaultdict(int)
        for words in part:
            for at in enumerate(words):
                votes[at] += len(holders[words])
                have[at] += 1
        constant = [at for at in votes if votes[at] * 2 > heard]
        fits = []
        if len(constant) * 10 >= n * 8:
            fits = [w for w in part if sum(w[p] != c for p, c in constant) * 10 <= n * 2]
        if fits:
            template |= dict.fromkeys(fits, len(template) + 1)
            rest = [[w for w in part if w not in set(fits)]]
        else:
            dividing = [at for at in votes if 1 < have[at] < len(part)]
            ranked = sorted(dividing, key=lambda at: (-votes[at], at[0], at[1].encode()))
            split = defaultdict(list)
            for words in part:
                own = next((at for at in ranked[:64] if words[at[0]] == at[1]), None)
                if own or len(ranked) > 64:
                    split[own].append(words)
            rest = split.values()
        open_parts += [r for r in rest if len(r) > 1]
    found = defaultdict(set)
    for words, own in holders.items():
        found[template.get(words, words)] |= own
    clean = {}
    for i, own in lines.items():
        homes = [found[template.get(tuple(mask[x]), tuple(mask[x]))] if x.strip(SPACES) else {i} for x in own]
        clean[i] = "\n".join(x for x, home in zip(own, homes) if len(home) < min_docs or min(home) == i)
    return clean


def test_query_equals_the_rule(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    got = {r["doc_id"]: r["clean_text"] for r in line_dedup.query(spark, SF_DIR).collect()}
    assert got == by_definition(texts)


@pytest.mark.parametrize("seed", range(3))
def test_leaves_with_several_templates_equal_the_rule(spark, seed):
    """Lines of few beginnings and lengths, so that leaves hold templates, copies and other lines."""
    draw = random.Random(seed)
    words = ["red", "blue", "tall", "ten", "sea", "old", "9", "way"]
    bodies = [["a", "b", "c", *draw.choices(words, k=9)] for _ in range(6)]
    texts = {}
    for i in range(60):
        lines = []
        for _ in range(draw.randrange(6)):
            own = list(draw.choice(bodies))
            for _ in range(draw.randrange(5)):
                own[draw.randrange(3, 12)] = draw.choice(words)
            lines.append(draw.choice([" ", "  ", "\t"]).join(own))
        lines += [f"a b c {' '.join(draw.choices(words, k=draw.randrange(4)))}"] * draw.randrange(2)
        texts[i] = "\n".join(lines)
    assert cleaned(spark, list(texts.values())) == by_definition(texts)


def test_variable_fields_are_one_template(spark):
    texts = [f"own line {'abc'[i]} x\nPage {i} of 20, printed 2024-01-0{i}\nlast {'xyz'[i]} y" for i in range(3)]
    got = cleaned(spark, texts)
    assert got[0] == texts[0]
    assert got[1] == "own line b x\nlast y y" and got[2] == "own line c x\nlast z y"


def test_words_that_vary_are_generalised_by_the_majority(spark):
    line = "served to you by the host named {} in this very town today"
    names = ["alpha", "beta", "gamma", "delta"]
    got = cleaned(spark, [f"unique {n * 2}\n{line.format(n)}" for n in names])
    assert got == {0: f"unique alphaalpha\n{line.format('alpha')}"} | {
        i: f"unique {n * 2}" for i, n in enumerate(names) if i
    }


def test_a_leaf_has_several_templates(spark):
    first = "served to you by the host named {} in this very town today"
    other = "served to you on a plate of {} with cold milk and bread"
    names = ["alpha", "beta", "gamma", "delta"]
    got = cleaned(spark, [f"unique {n * 2}\n{first.format(n)}\n{other.format(n)}" for n in names])
    assert got[0].count("\n") == 2
    assert all(got[i] == f"unique {n * 2}" for i, n in enumerate(names) if i)


def test_a_template_is_found_beside_copied_and_unrelated_lines(spark):
    line = "served to you by the host named {} in this very town today"
    copied = "served to you as it was asked for by all our guests"
    unrelated = [f"served to you {' '.join(w * (i + 2) for w in 'abcdefghi')}" for i in range(6)]
    texts = [line.format(n) for n in ("alpha", "beta", "gamma", "delta")] + [copied] * 9 + unrelated
    got = cleaned(spark, texts)
    assert [got[i] for i in range(4)] == [texts[0], "", "", ""]
    assert [got[i] for i in range(4, 13)] == [copied] + [""] * 8
    assert [got[i] for i in range(13, 19)] == unrelated


def test_unrelated_lines_with_the_same_beginning_stay(spark):
    texts = ["the and of red birds fly over hills", "the and of blue boats sink under waves"]
    assert cleaned(spark, texts) == dict(enumerate(texts))


def test_repetition_within_one_document_stays(spark):
    texts = ["same line here\nsame line here\n\nother", "new words only"]
    assert cleaned(spark, texts) == dict(enumerate(texts))


def test_more_documents_may_be_asked_for(spark):
    texts = ["shared line a b", "shared line a b", "twice\nthrice so", "thrice so", "thrice so"]
    got = cleaned(spark, texts, min_docs=3)
    assert got == {0: texts[0], 1: texts[1], 2: texts[2], 3: "", 4: ""}


def test_nulls_blank_lines_repeated_rows_and_clashing_names(spark):
    rows = [(1, "a b\n\n \nc d", 5), (1, "a b\n\n \nc d", 5), (2, None, 6), (None, "c d", 7), (3, "", 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_lines int").coalesce(1)
    got = dedup_lines(docs)
    assert got.columns == ["doc_id", "clean_text", "n_lines", "n_dropped"]
    found = sorted((r["doc_id"] or 0, r["clean_text"], r["n_lines"], r["n_dropped"]) for r in got.collect())
    assert found == [(0, "c d", 1, 0), (1, "\n ", 2, 2), (1, "a b\n\n ", 2, 1), (2, "", 0, 0), (3, "", 0, 0)]
    assert dedup_lines(docs.filter(F.lit(False))).collect() == []


def test_a_long_text(spark):
    text = "\n".join(f"line {'x' * (i % 50)} q{'y' * (i // 50)}" for i in range(5000)) + "\n" + "w " * 50000
    got = cleaned(spark, [text, "z\n" + text])
    assert got == {0: text, 1: "z"}


def test_masking_by_line_equals_masking_the_text(spark):
    texts = [None, "", "\n", "no number\n  here \t", "a1 b\n\x0bc 22 \nd\n 3", "x\ty 7\r\nz  9z", "\u0663 \U0001d7d8\ne", "ends 1"]
    rows = documents(spark, texts).select(F.col("text").alias("_text"))
    whole = F.transform(line_dedup._lines(line_dedup.masked(F.col("_text"))), lambda x: F.btrim(x, F.lit(line_dedup.SPACE)))
    for r in rows.select(whole.alias("a"), line_dedup._masked_lines(F.col("_text")).alias("b")).collect():
        assert r["a"] == r["b"]


def test_the_words_of_a_line_are_fetched_once(spark, monkeypatch):
    """From the first row that has it: the lines themselves are not grouped or dealt by leaf."""
    plans = {}

    def staged(df, name, own=line_dedup.stage):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        out = own(df, name)
        plans[name, "rows"] = out
        return out

    monkeypatch.setattr(line_dedup, "stage", staged)
    texts = ["the one line here\nthe one line there", "the one line here\nalone"] * 20 + [None, "the one line here"]
    cleaned(spark, texts)
    assert "keys=[m#" not in plans["leaf-members"]
    rows = [(r["words"], r["docs"]) for r in plans["leaf-members", "rows"].collect()]
    assert sorted(rows) == [("the one line here".split(), 41), ("the one line there".split(), 20)]


def test_the_path_has_no_python(spark):
    plan = line_dedup.query(spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan

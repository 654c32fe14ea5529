from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
from llm import helpers as h

from tidebook.llm import quotes, resampling, templates
from tidebook.llm.queries import op2_quotation_links, op3_importance_resampling, op7_template_leaks

SF = "/root/testdata/sf0.01"


def test_leaks_equal_plain_search(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    items = {r.item_id: r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    got = {(r.doc_id, r.item_id) for r in op7_template_leaks(spark, SF).collect()}

    def plain(text):
        return re.findall(r"[^\W_]+", text.lower())

    # Items whole in a text are found; whatever is found shares a long run of words with its item.
    for doc_id, text in docs.items():
        words = " ".join(plain(text))
        for item_id, item in items.items():
            tokens = plain(item)
            runs = sum(" ".join(tokens[i : i + 8]) in words for i in range(len(tokens) - 7))
            if " ".join(tokens) in words and len(tokens) >= 16:
                assert (doc_id, item_id) in got
            if (doc_id, item_id) in got:
                assert runs >= 3
    assert got


ITEM = "a train leaves Boston with 40 tons of coal and travels 12 miles while another train leaves Boston with 40 sheep on board"


def test_reworded_questions(spark):
    bench = spark.createDataFrame([(1, ITEM), (2, ITEM), (3, "short item here"), (4, None), (5, "")], "item_id long, text string")
    other = ITEM.replace("Boston", "Denver").replace("40", "55").replace("12", "7,000.5").replace("miles", "km")
    mixed = other.replace("55", "56", 1)
    docs = spark.createDataFrame(
        [
            (10, f"Intro text. {ITEM}"), (11, f"so {other} and more"), (12, mixed), (13, "nothing of it at all"),
            (14, "we saw a short item here today"), (15, None), (16, ""), (None, ITEM), (11, f"so {other} and more"),
        ],
        "doc_id long, text string",
    )
    rows = {(r.doc_id, r.item_id): r for r in templates.find_leaks(docs, bench).collect()}
    assert set(rows) == {(10, 1), (11, 1), (14, 3), (None, 1)}
    assert rows[11, 1].reworded and not rows[10, 1].reworded and rows[10, 1].coverage == 1.0
    assert templates.find_leaks(docs.limit(0), bench).count() == 0
    assert templates.find_leaks(docs, bench.limit(0)).count() == 0
    assert templates.find_leaks(h.awkward(spark), bench).count() == 0


def test_copies_in_any_case(spark):
    short = "What is the capital of France?"
    bench = spark.createDataFrame([(1, ITEM), (2, short)], "item_id long, text string")
    cases = [str.upper, str.title, str.lower, str.swapcase]
    texts = [f"Before it. {case(item)} After it." for item in (ITEM, short) for case in cases]
    docs = spark.createDataFrame([*enumerate(texts), (99, "A TRAIN LEAVES BOSTON AND THE CAPITAL OF FRANCE")], "doc_id long, text string")
    rows = {(r.doc_id, r.item_id): r for r in templates.find_leaks(docs, bench).collect()}
    assert set(rows) == {(i, 1 if i < 4 else 2) for i in range(8)}
    assert all(r.coverage == 1.0 and not r.reworded for r in rows.values())
    kept = {r.doc_id for r in templates.without_leaks(docs, bench).collect()}
    assert kept == {99}


def test_names_that_open_sentences_and_short_items(spark):
    items = [
        "Tom has 3 apples. Tom eats 2 of them today.",
        "What is the capital of France?",
        "Yesterday in the market a farmer met Tom and sold 12 eggs to him, so Tom paid 4 dollars to the farmer.",
        "Does Tom own 7 red kites?",
    ]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    docs = [
        (10, "Ann has 5 apples. Ann eats 1 of them today.", 0),
        (11, "Mary Ann has 5 apples. Mary Ann eats 1 of them today.", 0),
        (12, "It was Mary Ann has 5 apples. Mary Ann eats 1 of them today.", 0),
        (13, "as in (What is the capital of France?)", 1),
        (14, 'asked "What is the capital of France?" twice', 1),
        (15, "number 3 What is the capital of France, so", 1),
        (16, "he asked Jim What is the capital of France Is it so", 1),
        (17, "so, what is the capital of New Zealand?", 1),
        (18, items[2].replace("Tom", "Mary Ann Smith").replace("12", "15"), 2),
        (19, "Does Mary Ann own 9 red kites?", 3),
        (20, "Ann has 5 apples. Bob eats 1 of them today.", None),
        (21, "Where is the capital of France?", None),
        (22, "Will Tom own 7 red kites?", None),
    ]
    table = spark.createDataFrame([d[:2] for d in docs], "doc_id long, text string")
    rows = {(r.doc_id, r.item_id): r for r in templates.find_leaks(table, bench).collect()}
    assert set(rows) == {(i, item) for i, _, item in docs if item is not None}
    assert {i for (i, _), r in rows.items() if not r.reworded} == {13, 14, 15, 16}


def _plain_links(messages):
    """parent_turn, root_turn and depth of each message, by scanning each conversation."""

    def norm(t):
        return " ".join(re.findall(r"[^\W_]+", t.lower()))

    said, out = {}, {}
    for conv, turn, text in sorted(messages):
        votes = Counter()
        asked = set()
        for line in text.split("\n"):
            marks = re.match(r"^(?:[ \t]*>)+", line)
            if marks and marks.group(0).count(">") == 1:
                asked.add(norm(line[marks.end() :]))
        for q in asked - {""}:
            turns = [t for t in said.get((conv, q), []) if t < turn]
            if turns:
                votes[max(turns)] += 1
        parent = max(votes, key=lambda t: (votes[t], t)) if votes else None
        root, depth = (turn, 0) if parent is None else (out[conv, parent][1], out[conv, parent][2] + 1)
        out[conv, turn] = (parent, root, depth)
        for line in text.split("\n"):
            if not re.match(r"^(?:[ \t]*>)+", line) and norm(line):
                said.setdefault((conv, norm(line)), []).append(turn)
    return out


def test_links_equal_plain_scan(spark):
    rng, messages = random.Random(4), []
    for conv in range(6):
        lines = []
        for turn in range(0, 700 if conv == 0 else 12, rng.choice([1, 2])):
            own = [f"Line {rng.randrange(40)} of {conv}, ok!" for _ in range(rng.randrange(3))]
            quoted = [f"> {rng.choice(lines).upper()}" for _ in range(rng.randrange(3))] if lines else []
            deep = [f"> > {rng.choice(lines)}"] if lines and rng.random() < 0.3 else []
            messages.append((conv, turn, "\n".join(quoted + deep + own)))
            lines += own
    df = spark.createDataFrame([(c, t, "user", x) for c, t, x in messages], "conv_id long, turn long, role string, text string")
    rows = quotes.link_quotes(df).collect()
    got = {(r.conv_id, r.turn): (r.parent_turn, r.root_turn, r.depth) for r in rows}
    assert got == _plain_links(messages)
    assert not any(line.startswith(">") for r in rows for line in r.text.split("\n"))
    assert any(r.depth > 3 for r in rows) and any(r.quote_levels == 2 for r in rows)


def test_messages_of_other_conversations_and_awkward_rows(spark):
    rows = [
        (1, 0, "user", "A first thought.\n\nAnother one", "x"), (2, 0, "user", "> a FIRST thought\nYes", "x"),
        (2, 1, None, None, "x"), (2, 2, "user", "", "x"), (None, 3, "user", ">> hm", "x"), (4, None, "user", "own", "x"),
        (2, 0, "user", "> a FIRST thought\nYes", "x"),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, depth string")
    got = {(r.conv_id, r.turn): r for r in quotes.link_quotes(df).collect()}
    assert len(got) == 6
    assert got[2, 0].origin_conv == 1 and got[2, 0].text == "Yes" and got[2, 0].parent_turn is None
    assert got[1, 0].text == "A first thought.\n\nAnother one"
    assert got[None, 3].quote_levels == 2 and got[None, 3].text == ""
    assert quotes.link_quotes(df.limit(0)).count() == 0


def test_query_links_quotes_of_all_levels(spark, folder):
    rows = [
        (1, 0, "user", "The first thing"), (1, 1, "user", "> The first thing\nA second thing"),
        (1, 2, "user", ">> The first thing\nmine"), (1, 3, "user", "> A second thing\n> > The first thing\n>>> nobody said\nok"),
        (1, 4, "user", "> not said\n>> A second thing\n>>> The first thing\n>>> mine"),
    ]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{folder}/conversations.parquet")
    got = {r.turn: r for r in op2_quotation_links(spark, folder).collect()}
    assert {t: r.parent_turn for t, r in got.items()} == {0: None, 1: 0, 2: 0, 3: 1, 4: 1}
    assert {t: (r.root_turn, r.depth) for t, r in got.items()} == {0: (0, 0), 1: (0, 1), 2: (0, 1), 3: (0, 2), 4: (0, 2)}
    links = {t: [tuple(x) for x in r.links] for t, r in got.items()}
    assert links == {0: [], 1: [(1, 0, 1)], 2: [(2, 0, 1)], 3: [(1, 1, 1), (2, 0, 1)], 4: [(2, 1, 1), (3, 0, 1), (3, 2, 1)]}


def test_rewrapped_passages_and_repeated_turns(spark, folder):
    long = "We should move the whole meeting to the following Tuesday because nobody can come"
    wrapped = "> We should move the\n> whole meeting to the following\n> Tuesday because nobody can come\nFine"
    rows = [
        (1, 0, "user", f"{long}.\nBye"), (1, 1, "user", wrapped), (1, 2, "user", wrapped.replace("> ", ">> ")),
        (2, 5, "user", wrapped), (2, 6, "user", "one"), (2, 6, "user", "two"), (2, 6, "user", "two"),
        (2, 7, "user", "> one\nyes"), (2, 7, "user", "> two\nno"),
    ]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{folder}/conversations.parquet")
    out = op2_quotation_links(spark, folder).collect()
    got = {(r.conv_id, r.turn, r.tie): r for r in out}
    assert len(out) == len(got) == len(rows)
    assert got[1, 1, 0].parent_turn == got[1, 2, 0].parent_turn == 0
    for key, level in {(1, 1, 0): 1, (1, 2, 0): 2, (2, 5, 0): 1}.items():
        (p,) = got[key].passages
        assert (p.level, p.origin_conv, p.origin_turn, p.n_windows, p.n_found) == (level, 1, 0, 11, 11)
    assert got[2, 5, 0].parent_turn is None and got[2, 5, 0].origin_conv == 1
    assert sorted(got[2, 6, t].text for t in range(3)) == ["one", "two", "two"]
    assert [got[2, 7, t].parent_turn for t in range(2)] == [6, 6]


def test_query_keeps_every_message(spark):
    assert op2_quotation_links(spark, SF).count() == spark.read.parquet(f"{SF}/conversations.parquet").count()


def test_resampling_prefers_good_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").count()
    rows = op3_importance_resampling(spark, SF).collect()
    assert len(rows) == int(np.ceil(resampling.SHARE * docs))
    kept = {r.doc_id for r in rows}
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    good, bad = ([r.doc_id in kept for r in labels if r.quality == q] for q in (1, 0))
    assert np.mean(good) > 0.85 and np.mean(bad) < 0.5


def test_top_k_is_exact(spark):
    rng = np.random.default_rng(0)
    for values in (rng.normal(size=30_000), np.repeat([1.0, 2.0, 5.0], 20_000), np.array([3.0])):
        df = spark.createDataFrame([(float(v),) for v in values], "key double")
        for k in (0, 1, 7, len(values) // 3, len(values), len(values) + 1):
            got = sorted((r.key for r in resampling.top_k(df, "key", k).collect()), reverse=True)
            ordered = sorted(values.tolist(), reverse=True)
            want = [v for v in ordered if k and v >= ordered[min(k, len(values)) - 1]]
            assert got == want


def test_draws_follow_the_weights(spark):
    rows = [(i, "a" if i % 2 else "b") for i in range(4000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    model = np.zeros(8)
    one = resampling.importance(df, model).collect()
    keys = np.array([r.key for r in one])
    assert abs(keys.mean() - 0.5772) < 0.1 and abs(keys.std() - np.pi / np.sqrt(6)) < 0.1


def test_resampling_awkward(spark):
    docs = h.awkward(spark)
    labels = spark.createDataFrame([(4, 1), (None, 1), (5, None)], "doc_id long, quality int")
    for known in (labels, labels.limit(0)):
        assert len(h.AWKWARD) * resampling.SHARE <= resampling.resample(docs, known).count() <= len(h.AWKWARD)
    assert resampling.resample(docs.limit(0), labels).count() == 0

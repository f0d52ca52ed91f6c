"""Classifiers, URL rules, chat formatting, samples and the pipeline."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from conftest_llm import prose, text_rows
from pyspark.sql import functions as F

import corpus_pipeline
from basketry.llm import chat, quality, sampling, toxicity, urls
from basketry.llm.queries import QUERIES, SQL, URL_RULES

LABELS = "doc_id long, quality int, toxic int"


def accuracy(got, labels, name):
    scores = {r["doc_id"]: r for r in got}
    held = [(scores[r["doc_id"]], r[name]) for r in labels if scores[r["doc_id"]]["held_out"]]
    right = sum(s["predicted"] == y for s, y in held) / len(held)
    good = [s["score"] for s, y in held if y == 1]
    bad = [s["score"] for s, y in held if y == 0]
    return right, np.mean([a > b for a in good for b in bad])


@pytest.mark.parametrize(
    ("query", "name", "folds", "out", "least"),
    [("op3_quality_classifier", "quality", 3, 1, 0.95), ("op7_toxicity", "toxic", 4, 2, 0.9)],
)
def test_classifiers_on_held_out_rows(spark, query, name, folds, out, least):
    folder = "/root/testdata/sf0.1"  # enough labelled rows to learn from
    got = QUERIES[query](spark, folder).collect()
    assert len(got) == spark.read.parquet(f"{folder}/documents.parquet").count()
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % folds == out)
        assert 0 <= r["score"] <= 1
        assert r["predicted"] == (r["score"] >= (0.5 if name == "quality" else 0.3))
    right, order = accuracy(got, spark.read.parquet(f"{folder}/labels.parquet").collect(), name)
    assert right > least and order > least


@pytest.mark.parametrize("operator", [quality, toxicity])
def test_classifiers_take_odd_documents_and_labels(spark, odd_docs, no_docs, operator):
    labels = spark.createDataFrame([(1, 1, 0), (3, 0, 1), (9, 1, 0), (None, 1, 1), (10, None, None)], LABELS)
    nothing = spark.createDataFrame([], LABELS)
    for given in (labels, nothing):
        got = operator.classify(odd_docs, given).collect()
        assert Counter(r["doc_id"] for r in got) == Counter(i for i, _ in text_rows(odd_docs))
        assert all(0 <= r["score"] <= 1 for r in got)
        assert operator.classify(no_docs, given).isEmpty()


def test_sample_leaves_out_the_held_out_fold(spark, documents, folder):
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = sampling.labelled(documents, labels, "quality", 3, 1, 10).collect()
    assert Counter(r["y"] for r in rows)[1] == 10
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 3 != 1 for r in rows)


def within(word: str, term: str) -> bool:
    """At most one letter put in, left out or changed."""
    if abs(len(word) - len(term)) > 1:
        return False
    row = list(range(len(term) + 1))
    for k, a in enumerate(word, 1):
        last, row = row, [k]
        for j, b in enumerate(term, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (a != b)))
    return row[-1] <= 1


def test_automaton_equals_the_distance():
    terms = [
        toxicity.Term("clown", 1.0, False),
        toxicity.Term("crown", 0.5, False),
        toxicity.Term("scum", 0.8, False),
        toxicity.Term("achl", 0.7, True),
    ]
    automaton = toxicity.compile_terms(terms)
    rng = np.random.default_rng(0)
    words = ["clown", "clowns", "lown", "cxown", "scum", "scam", "achlich", "achl", "ach", "x", "clownsx"]
    words += ["".join(rng.choice(list("clownrs"), rng.integers(1, 8))) for _ in range(3000)]
    data = np.frombuffer("".join(words).encode(), np.uint8)
    end = np.cumsum([len(w) for w in words])
    got = toxicity.match(automaton, data, end - [len(w) for w in words], end)
    for word, value in zip(words, got, strict=True):
        best = 0.0
        for t in terms:
            if t.beginning:
                best = max(best, t.weight * word.startswith(t.text))
            elif word == t.text:
                best = max(best, t.weight)
            elif len(t.text) >= 5 and within(word, t.text):
                best = max(best, t.weight * toxicity.MISSPELLED)
        assert value == best, word


def learned(spark, toxic, clean):
    rows = [(k, t, 1) for k, t in enumerate(toxic)] + [(1000 + k, t, 0) for k, t in enumerate(clean)]
    return toxicity.learn_terms(spark.createDataFrame(rows, "doc_id long, text string, y int"))


def weights_of(terms, words):
    data = np.array([ord(c) for c in "".join(words)])
    end = np.cumsum([len(w) for w in words])
    return toxicity.match(toxicity.compile_terms(terms), data, end - [len(w) for w in words], end)


def test_whole_words_stay_beside_beginnings(spark):
    toxic = [prose(900 + k, 30) + " " + w for k in range(8) for w in ("idiot idiots idiotic", "ass asshole")]
    clean = [prose(950 + k, 30) + " assembly idle" for k in range(60)]
    terms = learned(spark, toxic, clean)
    assert {"idiot", "idiots", "idiotic", "ass", "asshole"} <= {t.text for t in terms if not t.beginning}
    found = weights_of(terms, ["id1ots", "id1ot", "asshole", "ashole", "idiocy", "assembly", "idle"])
    assert (found[:5] > 0).all() and (found[5:] == 0).all()


def test_beginnings_count_texts_and_no_term_is_one_too_many(spark):
    # Three toxic texts with two words each are three texts, not six.
    toxic = [prose(900 + k, 30) + " zorkable zorkish" * (k < 3) for k in range(12)]
    codes = ["".join(chr(97 + n // 26**j % 26) for j in range(3)) + "qv" for n in range(900)]
    toxic += [" ".join(codes)] + [" ".join(codes) + f" {k}" for k in range(6)]
    terms = learned(spark, toxic, [prose(950 + k, 150) for k in range(100)])
    assert not any(t.text.startswith("zor") for t in terms)
    assert set(codes) <= {t.text for t in terms if not t.beginning}
    assert (weights_of(terms, codes) > 0).all()


def test_words_are_letters_of_any_script(spark):
    terms = [toxicity.Term("stupid", 1.0, False), toxicity.Term("idio", 0.8, True)]
    terms += [toxicity.Term("дурак", 1.0, False), toxicity.Term("笨蛋", 1.0, True)]
    automaton = toxicity.compile_terms(terms)
    texts = ["“idiot”", "idiot’s", "«idiot»", "stup\u00efd", "st\u0443pid", "stu\u00adpid", "ｓｔｕｐｉｄ"]
    texts += ["stupid…", "stupid\u00a0x", "дурaк", "дурик", "你真是个大笨蛋。", "idiot你", "x" * 50 + " stupid"]
    found = toxicity.evidence(automaton, pa.array([*texts, "stöpïd", "一二三", "x" * 60]))
    assert (found[: len(texts), 0] > 0).all() and (found[len(texts) :, 0] == 0).all()
    # Learned from texts without spaces, too, and the same way as matched.
    toxic = [prose(900 + k, 30) + f" “fiendish’s” 天地{k}玄黄笨蛋宇宙" for k in range(8)]
    clean = [prose(950 + k, 60) + " 天地玄黄宇宙" for k in range(60)]
    terms = learned(spark, toxic, clean)
    assert any(t.text == "fiendish" and not t.beginning for t in terms)
    found = toxicity.evidence(toxicity.compile_terms(terms), pa.array(["大笨蛋啊", "天地玄黄宇宙", "”fiendish“"]))
    assert found[0, 0] > 0 and found[1, 0] == 0 and found[2, 0] > 0


def test_quoted_and_lone_hits_count_less():
    automaton = toxicity.compile_terms([toxicity.Term("clown", 1.0, False)])
    filler = prose(40, 200)
    texts = ["clown " * 4 + filler, '"clown" ' * 4 + filler, "clown " + filler, filler, "", None]
    found = toxicity.evidence(automaton, pa.array(texts, pa.string()))
    assert found[0, 1] > found[1, 1] > 0 and found[0, 1] > found[2, 1] > 0
    assert (found[3:] == 0).all()


def test_quoted_phrases_of_all_kinds_count_less_than_direct_use():
    automaton = toxicity.compile_terms([toxicity.Term("clown", 1.0, False)])
    filler = prose(41, 60)
    direct = [
        "you stupid clown",
        "don't be such a clown, it's sad",
        "clown's play, dogs' food",
        "the \"good\" clown and the \"bad\" one",
        "he opened \"with\nclown\" and left",
        "5 > 4 you clown",
        "“ " + "la " * 60 + "clown " + "”",
        "",
    ]
    cited = [
        'you "stupid old clown" there',
        "you “stupid old clown” there",
        "you „stupid old clown“ there",
        "you « stupid old clown » there",
        "you »stupid old clown« there",
        "you ‘stupid old clown’ there",
        "you 'a stupid clown's hat' there",
        "you 「stupid old clown」 there",
        "you (\"stupid 'old' clown!\") there",
        "hello\n  > stupid old clown there",
    ]
    found = toxicity.evidence(automaton, pa.array([f"{t} \n{filler}" for t in direct + cited]))
    assert (found[: len(direct), 3] == 0).all() and (found[len(direct) :, 3] == 1).all()
    assert found[len(direct) :, 0].max() < 0.5 * found[: len(direct) - 1, 0].min()
    # A reporting word takes still more away, but not from direct use or in another text.
    told = ["he wrote “you clown” to", "he took “you clown” to", "he wrote you clown to", "he wrote"]
    found = toxicity.evidence(automaton, pa.array([*told, "“you clown” to"]))
    assert 0 < found[0, 1] < found[1, 1] < found[2, 1] == pytest.approx(1)
    assert found[4, 1] == pytest.approx(found[1, 1]) and (found[3] == 0).all()


# URL rules


def verdict_by_hand(url):
    m = re.search(r"://([^/?#]*)([^?#]*)", url or "", re.S)
    host, path = (m[1], m[2]) if m else ("", "")
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    best = max(
        (
            (len(h + p), h + p, v)
            for v, h, p in (
                ("allow", "com", "/"),
                ("block", "example.com", "/en/"),
                ("allow", "www.example.com", "/en/"),
                ("block", "net", "/es/"),
                ("block", "net", "/fr/"),
            )
            if (host == h or host.endswith("." + h)) and path.startswith(p)
        ),
        default=(0, None, "allow"),
    )
    return host, path, best[1], best[2]


def test_url_rules(spark, folder):
    odd = [
        None,
        "",
        "no scheme",
        "http://",
        "HTTP://WWW.Example.COM/en/x?y=/en/",
        "https://example.com/en",
        "https://example.com/en/",
        "https://a.b.net/es/1#z",
        "https://net/fr/",
        "https://planet/fr/",
        "https://xexample.com/en/",
        "http://x.com",
        "http://x.com/://y.net/es/",
        "http://com/\nfoo",
        "http://É.COM/É",
    ]
    rows = [(k, u, "h", "v") for k, u in enumerate(odd + odd[:5])]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, rule string")
    got = urls.filter_urls(pages, URL_RULES).collect()
    names = ("host", "path", "rule", "verdict")
    assert {r["page_id"]: tuple(r[n] for n in names) for r in got} == {
        k: verdict_by_hand(u) for k, u, _, _ in rows
    }
    assert len(got) == len(rows)
    assert urls.filter_urls(pages.limit(0), URL_RULES).isEmpty()
    whole = QUERIES["op8_url_filters"](spark, folder).collect()
    given = {r["page_id"]: r["url"] for r in spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "url").collect()}
    assert {r["page_id"]: tuple(r[n] for n in names) for r in whole} == {
        k: verdict_by_hand(u) for k, u in given.items()
    }


def test_only_the_rarest_token_files_a_rule(spark):
    pages = spark.createDataFrame([("http://a.com/spam/x",), ("http://b.com/",)], "url string")
    rules = [urls.Rule("spam", "block", r"spam/x$", ("com", "spam")), urls.prefix_rule("allow", "com", "")]
    got = {r["url"]: (r["rule"], r["verdict"]) for r in urls.filter_urls(pages, rules, "block").collect()}
    assert got == {"http://a.com/spam/x": ("spam", "block"), "http://b.com/": ("com", "allow")}
    with pytest.raises(ValueError, match="no literal token"):
        urls.filter_urls(pages, [urls.Rule("x", "block", ".", ())])


def test_native_queries_run_no_python(spark, folder):
    for name in ("op8_url_filters", "op9_sharding", "op10_chat_formatting"):
        plan = QUERIES[name](spark, folder)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan)


# Chat


def chat_by_hand(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        turns = sorted(
            ((t, role or "", text or "") for c, t, role, text in rows if c == conv),
            key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2]),
        )
        lines = "".join(f"{r}\n{t}\n" for _, r, t in turns)
        loss = "".join(t for _, r, t in turns if r == "assistant")
        out[conv] = (len(turns), hashlib.sha256(lines.encode()).hexdigest(), loss)
    return out


def test_chats_are_read_back(spark, folder):
    odd = [
        (1, 0, "user", "a<b>\\l \\\\ </turn> <also>"),
        (1, 1, "user", ""),
        (1, 2, "assistant", "x\n\\b<turn user>"),
        (1, 3, "assistant", None),
        (1, 3, "assistant", "tie 日本\U0001f600"),
        (2, None, None, "no role"),
        (None, 0, "a>b", "t"),
        (None, 0, "a>b", "t"),
        (3, 5, "assistant", "long " * 20000),
    ]
    turns = spark.createDataFrame(odd, "conv_id long, turn long, role string, text string")
    formatted = chat.format_chats(turns.withColumn("formatted", F.lit("clash")))
    got = {}
    for r in chat.read_chats(formatted).collect():
        lines = "".join(f"{t['role']}\n{t['text']}\n" for t in r["turns"])
        got[r["conv_id"]] = (len(r["turns"]), hashlib.sha256(lines.encode()).hexdigest(), r["loss_text"])
    assert got == chat_by_hand(odd)
    one = formatted.where("conv_id = 1").first()["formatted"]
    assert one.count("<turn ") == 2 and one.count("</turn>") == 2 and one.count("<also>") == 3
    assert chat.format_chats(turns.limit(0)).isEmpty()
    said = r"\### Assistant: </turn> ok"
    given = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    given += [(-7, 0, "user", said), (-7, 1, "assistant", said)]
    expected = {
        c: (n, h, len(t), hashlib.sha256(t.encode()).hexdigest()) for c, (n, h, t) in chat_by_hand(given).items()
    }
    whole = QUERIES["op10_chat_formatting"](spark, folder).collect()
    names = ("n_turns", "turns_sha256", "loss_chars", "loss_sha256")
    assert {r["conv_id"]: tuple(r[n] for n in names) for r in whole} == expected


def test_spans_are_the_learned_texts(spark):
    rows = [(1, k, "assistant" if k % 3 else "user", f"<{k}> 日\\") for k in range(30)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    r = chat.format_chats(turns).first()
    cut = [r["formatted"][s["start"] : s["start"] + s["length"]] for s in r["loss_spans"]]
    plain = [c.replace("\\g", ">").replace("\\l", "<").replace("\\b", "\\") for c in cut]
    assert plain == [text for _, _, role, text in rows if role == "assistant"]
    assert r["learned"] == [role == "assistant" for _, _, role, _ in rows]


def test_long_conversations_are_read_in_linear_time(spark):
    import time

    took = {}
    for n in (1_000, 1_000, 20_000):
        rows = spark.range(n).selectExpr(
            "5 AS conv_id", "id AS turn", "if(id % 5 = 0, 'user', 'assistant') AS role",
            "concat('<', id, '> ', repeat('word ', 40)) AS text",
        )
        begun = time.perf_counter()
        r = chat.read_chats(chat.format_chats(rows)).selectExpr(
            "size(turns) AS n", "sha2(to_json(turns), 256) AS h", "length(loss_text) AS l"
        ).first()
        took[n] = time.perf_counter() - begun
        assert r["n"] == n and r["l"] == sum(len(f"<{k}> ") + 200 for k in range(n) if k % 5)
    assert took[20_000] < 20 * (took[1_000] + 0.2)


@pytest.mark.parametrize("name", sorted(SQL))
def test_queries_with_sql_give_the_same_rows(spark, folder, name):
    con = duckdb.connect()
    for table in ("pages", "conversations", "documents"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    cursor = con.execute(SQL[name])
    names = [d[0] for d in cursor.description]
    got = Counter(tuple(r[n] for n in names) for r in QUERIES[name](spark, folder).collect())
    assert got == Counter(map(tuple, cursor.fetchall()))


# Pipeline


def test_pipeline_stages_keep_clean_documents_and_drop_planted_ones(spark, folder, tmp_path_factory):
    clean = [(k, prose(600 + k, 150)) for k in range(20)]
    passage = prose(700, 60)
    bench = spark.read.parquet(f"{folder}/benchmark.parquet").first()["text"]
    planted = [
        (30, clean[0][1]),
        (31, clean[1][1].replace(clean[1][1].split()[70], "other", 1)),
        (32, prose(701, 40) + "\n" + passage),
        (33, prose(702, 40) + "\n" + passage),
        (34, prose(703, 30) + " " + bench + " " + prose(704, 30)),
        (35, " ".join(w + " idiot moron" for w in prose(705, 30).split())),
        (36, None),
        (37, ""),
    ]
    rows = [(i, t, "en", "s", len(t or "")) for i, t in clean + planted]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    real = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        if name == "toxicity":
            # The labels are of the given documents: learn there, judge here.
            labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
            docs = toxicity.reject(docs, toxicity.train(real, labels))
        else:
            docs = stage(spark, docs, folder)
        path = str(tmp_path_factory.mktemp("stage") / name)
        docs.write.parquet(path)
        docs = spark.read.parquet(path)
        out[name] = docs
        if name != "best_fit_packing":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    ids = {n: {r["doc_id"] for r in d.select("doc_id").collect()} for n, d in out.items()}
    everything = {i for i, _ in clean + planted}
    assert ids["toxicity"] == everything - {35}
    assert ids["jaccard_join"] == everything - {35, 30, 31}
    texts = {r["doc_id"]: r["text"] for r in out["suffix_array_dedup"].collect()}
    assert ids["suffix_array_dedup"] == ids["jaccard_join"]
    assert all(texts[i] == t for i, t in clean)
    assert passage in texts[32] and passage not in texts[33] and len(texts[33]) < 450
    assert ids["decontamination"] == ids["suffix_array_dedup"] - {34}
    assert ids["best_fit_packing"] == ids["decontamination"]


def test_whole_pipeline_runs(spark, folder):
    out = corpus_pipeline.run(spark, folder)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert 0 < out.select("doc_id").distinct().count() < 200


CORPUS = "doc_id long, text string, lang string, source string, n_chars long"


def corpus(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], CORPUS).repartition(3)


def test_near_copies_leave_one_row_of_each_group_whatever_their_ids(spark, folder):
    def near(text):
        return text.replace(text.split()[70], "other", 1)

    a, b, c, d = (prose(800 + k, 150) for k in range(4))
    alone = prose(810, 150)
    rows = [(1, a), (3, near(a)), (3, b), (5, b), (None, c), (None, near(c)), (None, alone)]
    rows += [(7, d), (7, near(d)), (7, d), (None, d), (None, None), (None, ""), (8, None)]
    out = corpus_pipeline.drop_near_copies(spark, corpus(spark, rows), folder)
    got = Counter((r["doc_id"], r["text"]) for r in out.collect())
    assert got.pop((1, a)) == 1 and got.pop((3, b)) == 1 and got.pop((None, alone)) == 1
    assert got.pop((None, None)) == got.pop((None, "")) == got.pop((8, None)) == 1
    assert sorted(i or 0 for i, _ in got.elements()) == [0, 7]
    assert set(got) <= {(None, c), (None, near(c)), (7, d), (7, near(d))}


def test_contaminated_rows_do_not_take_their_namesakes(spark, folder):
    leak = prose(820, 30) + " " + spark.read.parquet(f"{folder}/benchmark.parquet").first()["text"]
    clean = [prose(830 + k, 80) for k in range(4)]
    rows = [(None, leak), (None, clean[0]), (None, None), (4, leak), (4, clean[1]), (4, clean[1]), (5, clean[2])]
    given = corpus(spark, rows).withColumn("__row", F.lit("mine"))
    for stage in (corpus_pipeline.drop_contaminated, corpus_pipeline.drop_near_copies):
        out = stage(spark, given, folder).collect()
        assert {r["__row"] for r in out} == {"mine"}
        if stage is corpus_pipeline.drop_contaminated:
            got = Counter((r["doc_id"], r["text"]) for r in out)
            assert got == Counter(row for row in rows if row[1] != leak)

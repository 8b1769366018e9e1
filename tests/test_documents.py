"""HTML, sections, chunks, provider and whole runs."""

from __future__ import annotations

import json
import random
import re
import shutil
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quaestor.operators import chunks as ch
from quaestor.operators import generate as ge
from quaestor.operators import html as hm
from quaestor.operators import sections as se
from quaestor.operators import verify as vf
from quaestor.operators.ordinals import with_ordinal
from quaestor.options import Options
from quaestor.plans import build as bd
from quaestor.plans import maintain as mt
from quaestor.sources import datasets as ds
from quaestor.sources import filings as fl
from quaestor.sources import stages as st
from quaestor.sources.providers import OfflineProvider, Throttle, ask
from quaestor.streaming.filings import ingest

TABLE = ('<table><tr><th>Year</th><th colspan="2">Revenue</th></tr><tr><td>2025</td><td>$</td><td>130,497</td></tr>'
         "<tr><td> </td><td></td><td></td></tr></table>")


def test_table_and_text():
    assert hm.page_text(f"<body>{TABLE}</body>")[0] == "\n\n| Year | Revenue |  |\n|---|---|---|\n| 2025 | $ | 130,497 |\n\n"
    assert hm.page_text("<table><tr><td>one</td></tr></table>")[0] == "\n\n| one |\n\n"
    assert hm.page_text("<body><p>a<b> b </b><script>x()</script><!-- note -->&amp;c&#150;d</p></body>tail")[0] == "a b note &c–d "
    nested = hm.page_text("<table><tr><td>out<table><tr><td>in</td></tr></table></td></tr></table>")[0]
    assert nested == "\n\n| out in | in |\n|---|---|\n| in |\n\n"
    assert hm.page_text("<table><tr><td>a<!-- no --><script>s</script></td></tr>")[0] == "\n\n| a |\n\n"


def test_pages_with_odd_markup(spark):
    cases = {"<html><body><p>a &lt;b&gt; &amp;amp; &quot;</p><!-- c --><style>x{}</style>t</body></html>": 'a <b> &amp; " c t ',
             "<body>x": "x ", "<body></body>": "", "<body><a href='x>y'>z</a></body>": "z ", "plain": "plain ",
             "<body>a < b</body>": "a < b ", "<body>AT&T</body>": "AT&T ", "<BODY>  x  </BODY> y": "x ",
             "<!DOCTYPE html><p>no body</p>": "html no body ", "<body>&am<b>&#160;&copy;</b></body>": "&am © "}
    df = spark.createDataFrame([(k,) for k in cases], "html string")
    assert {r["html"]: r["text"] for r in hm.html_to_text(df).collect()} == cases


def plain_chunks(text, size, overlap, least):
    sents = re.split(r"(?<=[.!?])\s+", text)
    starts, cursor = [], 0
    for s in sents:
        at = text.find(s, cursor)
        starts.append(at)
        cursor = at + len(s)
    out, lo, start = [], 0, 0
    tok = [len(s) // 4 for s in sents]
    for i in range(len(sents)):
        if i > lo and sum(tok[lo:i]) + tok[i] > size:
            body = " ".join(sents[lo:i])
            if len(body) // 4 >= least:
                out.append((body, start, starts[i - 1] + len(sents[i - 1])))
            lo = next((j for j in range(i - 1, lo - 1, -1) if sum(tok[j:i]) >= overlap), i)
            start = starts[lo]
    body = " ".join(sents[lo:])
    if len(body) // 4 >= least:
        out.append((body, start, len(text)))
    return [(k, *c) for k, c in enumerate(out)]


def test_chunks_match_plain_loop(spark):
    rnd = random.Random(9)
    texts = ["".join("x" * rnd.randrange(0, 90) + rnd.choice(". |? |!  |.\n|, ").replace("|", "") for _ in range(rnd.randrange(1, 60))).strip() or "x"
             for _ in range(40)]
    df = spark.createDataFrame([(i, "s", t) for i, t in enumerate(texts)], "doc_id long, section string, full_text string")
    for o in (Options(chunk_size_tokens=60, chunk_overlap_tokens=15, min_chunk_tokens=8), Options(chunk_size_tokens=10, chunk_overlap_tokens=4, min_chunk_tokens=2)):
        rows = ch.chunk_sections(df, o).collect()
        for i, t in enumerate(texts):
            got = sorted((r["chunk_index"], r["text"], r["start_char"], r["end_char"]) for r in rows if r["doc_id"] == i)
            assert got == plain_chunks(t, o.chunk_size_tokens, o.chunk_overlap_tokens, o.min_chunk_tokens)


def test_sections_and_fallback(spark):
    body = "word " * 150
    late = f"Item 1. Business x Item 7. Management y Item 1A. Risk Factors {body}Item 1B. Unresolved Staff z Item 8: Financial Statements {body}"
    df = spark.createDataFrame([(1, late), (2, "short text"), (3, "")], "doc_id long, full_text string")
    rows = se.split_sections(df).collect()
    names = {(r["doc_id"], r["section"]) for r in rows}
    assert names == {(1, "Item 1A: Risk Factors"), (1, "Item 8: Financial Statements"),
                     *[(d, f"Section {i}") for d in (2, 3) for i in range(1, 6)]}
    assert "".join(r["full_text"] for r in sorted(rows, key=lambda r: r["section"]) if r["doc_id"] == 2) == "short text"
    assert next(r for r in rows if r["section"] == "Item 1A: Risk Factors")["full_text"].endswith("Unresolved Staff z")


def test_ordinals_per_scope(spark):
    rnd = random.Random(2)
    data = [(rnd.choice("aaaaab"), i * 3) for i in range(500)]
    rnd.shuffle(data)
    df = spark.createDataFrame(data, "s string, ord long").repartition(7)
    rows = with_ordinal(df, ["ord"], ["s"]).collect()
    for scope in "ab":
        assert [r["ordinal"] for r in sorted((r for r in rows if r["s"] == scope), key=lambda r: r["ord"])] == list(range(sum(d[0] == scope for d in data)))


def test_batches_and_odd_verdicts(spark):
    pairs = spark.createDataFrame([(i, f"q{i}") for i in range(7)], "ord long, question string")
    batched = vf.assign_batches(pairs)
    verdicts = spark.createDataFrame([(0, 1, True, True), (0, 1, True, False), (0, 9, True, True), (1, -1, True, True)],
                                     "batch_id long, qa_index int, is_faithful boolean, is_answerable boolean")
    plain = sorted((r["ord"], r["is_answerable"]) for r in vf.join_verdicts(batched, verdicts).collect())
    assert plain == [(1, False), (1, True)]
    wrapped = sorted(r["ord"] for r in vf.join_verdicts(batched, verdicts, wrap_negative=True).collect())
    assert wrapped == [1, 1, 6]


def test_parse_generation(spark):
    good = {"question": "q", "answer": "a", "source_passage": "p", "question_type": "comparison", "difficulty": "easy"}
    texts = [json.dumps({"qa_pairs": [good]}), json.dumps({"qa_pairs": [good, {**good, "question_type": "opinion"}]}), "no json",
             json.dumps({"qa_pairs": []}), json.dumps({})]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, response string")
    parsed = ge.parse_generation(df)
    assert [r["is_valid"] for r in parsed.orderBy("i").collect()] == [True, False, False, True, False]
    rows = ge.explode_generation(parsed, "i").collect()
    assert [(r["i"], r["question"], r["reasoning_steps"]) for r in rows] == [(0, "q", None)]


class Flaky:
    backend, rpm = "gemini", None

    def __init__(self, failures):
        self.failures = list(failures)

    def complete(self, prompt, kind, temperature):
        if self.failures:
            raise RuntimeError(self.failures.pop(0))
        return "{}"


def test_retries_and_throttle():
    waits = []
    assert ask(Flaky(["429", "503"]), None, "p", "generation", 0.0, Options(), waits.append) == ("{}", None, 3) and waits == [10, 20]
    assert ask(Flaky(["bad request"]), None, "p", "generation", 0.0, Options(), waits.append) == (None, "bad request", 1)
    assert ask(Flaky(["500"] * 9), None, "p", "generation", 0.0, Options(), lambda s: None)[1:] == ("500", 4)
    now, slept = [0.0], []

    def sleep(s):
        slept.append(s)
        now[0] += s

    throttle = Throttle(2, clock=lambda: now[0], sleep=sleep)
    for _ in range(3):
        throttle.wait()
    assert slept == [30.5, 30.5, 30.5]


def test_tasks_share_the_limit():
    sent = []
    for task in range(6):
        now = [0.0]

        def sleep(s, now=now):
            now[0] += s
        throttle = Throttle(18, 6, task, lambda now=now: now[0], sleep)
        for _ in range(30):
            throttle.wait()
            sent.append(now[0])
    sent.sort()
    assert all(sum(t <= u < t + 60 for u in sent) <= 18 for t in sent)
    with pytest.raises(ValueError):
        Throttle(18, 30)


def test_odd_pages_through_files_and_stream(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    pages = {"10k_1_a.htm": b"<p>caf\xe9 \xff ok</p>", "10k_2_b.htm": b"<p>&#55296;&#0;&#x110000;&#" + b"9" * 5000 + b";x</p>",
             "10k_3_c.htm": b"<p></p>", "10k_4_d.htm": "<p>é</p>".encode()}
    for name, body in pages.items():
        (folder / name).write_bytes(body)
    filings = fl.read_filings(spark, str(folder))
    rows = {r["cik"]: r for r in fl.filing_texts(filings).collect()}
    assert rows["1"]["full_text"] == "caf\ufffd \ufffd ok " and rows["2"]["full_text"] == "\ufffd" * 4 + "x "
    assert rows["3"]["full_text"] == "" and rows["4"]["full_text"] == "é " and all(r["text_error"] is None for r in rows.values())
    ingest(spark, str(folder), str(tmp_path / "out"), str(tmp_path / "progress"))
    moved = tmp_path / "moved"
    shutil.copytree(folder, moved)
    assert {r["doc_id"] for r in fl.read_filings(spark, str(moved)).collect()} == {r["doc_id"] for r in rows.values()}


def test_rejected_page_keeps_its_error(spark, monkeypatch):
    assert hm.page_text("<![if x]>a")[0] is not None
    monkeypatch.setattr(hm.FlatText, "feed", lambda self, html: (_ for _ in ()).throw(ValueError("no")))
    assert hm.page_text("x") == (None, "ValueError: no")


def test_parser_is_linear():
    began = time.time()
    assert len(hm.page_text("<p>x" * 100_000)[0]) == 200_000
    assert len(hm.page_text("<div><b>x" * 100_000 + "</i>" * 100_000)[0]) == 200_000
    assert time.time() - began < 15


def test_rate_window_keeps_rows_without_keys(spark):
    from quaestor.operators.rates import trailing_window
    df = spark.sql("SELECT * FROM VALUES (1, timestamp'2024-01-01 00:00:00', 'a'), (2, timestamp'2024-01-01 00:00:01', NULL), "
                   "(3, NULL, 'a'), (4, timestamp'2024-01-01 00:00:02', NULL) AS t(id, ts, who)")
    got = {r["id"]: (r["in_window"], r["wait_seconds"]) for r in trailing_window(df, "ts", ("who",), rpm=1).collect()}
    assert got == {1: (1, 0.0), 2: (1, 0.0), 3: (None, None), 4: (2, 60.0)}


def test_latest_filing(spark):
    text = ('{"name":"X","filings":{"recent":{"form":["8-K","10-K/A","10-K","10-K"],"accessionNumber":["0-0-1","0-0-2","0001045810-25-000023","0-0-4"],'
            '"primaryDocument":["a.htm","b.htm","c.htm","d.htm"]}}}')
    df = spark.createDataFrame([("1045810", text), ("7", text.replace('"10-K"', '"10-Q"'))], "cik string, submissions string")
    rows = {r["cik"]: r for r in fl.latest_filing(fl.parse_submissions(df).drop("submissions")).collect()}
    assert rows["1045810"]["url"] == "https://www.sec.gov/Archives/edgar/data/0001045810/000104581025000023/c.htm"
    assert rows["1045810"]["file_name"] == "10k_1045810_0001045810-25-000023.htm"
    assert rows["7"]["url"] is None


def test_read_submissions(spark, tmp_path):
    recent = {"form": ["10-K"], "accessionNumber": ["1-25-9"], "primaryDocument": ["x.html"]}
    (tmp_path / "CIK0000000042.json").write_text(json.dumps({"name": "Y", "filings": {"recent": recent}}, indent=1))
    row = fl.latest_filing(fl.read_submissions(spark, str(tmp_path))).first()
    assert (row["cik"], row["name"], row["accession"]) == ("0000000042", "Y", "1-25-9")
    assert row["file_name"] == "10k_0000000042_1-25-9.html"


def test_fetch_reports_failures(spark):
    def fake(url, agent):
        if "bad" in url:
            raise OSError("HTTP 404")
        return f"<body>{url}</body>"

    urls = spark.createDataFrame([("a", "u/good"), ("b", "u/bad")], "key string, url string")
    rows = {r["key"]: r for r in fl.fetch_all(urls, fetch=fake, pause=0.0).collect()}
    assert rows["a"]["body"] == "<body>u/good</body>" and rows["b"]["error"] == "HTTP 404"


def test_csv_and_jsonl(spark, tmp_path):
    data = [('say "hi", he said', "line one\nline two", "é ", "comparison", "easy", "s", 0.9, None), ("None", "", "x", "comparison", "hard", "s", 1.0, "r")]
    from quaestor.schemas import QA_PAIRS
    df = spark.createDataFrame(data, QA_PAIRS)
    ds.write_csv(df, str(tmp_path / "csv"))
    rows = sorted(map(tuple, ds.read_qa_pairs(spark, str(tmp_path / "csv")).collect()), key=str)
    assert rows == sorted([data[0], (None, None, *data[1][2:])], key=str)
    ds.write_jsonl(df, str(tmp_path / "jsonl"))
    assert sorted(map(tuple, ds.read_jsonl(spark, str(tmp_path / "jsonl")).collect()), key=str) == sorted(data, key=str)
    assert any('"reasoning_steps":null' in line for p in (tmp_path / "jsonl").glob("part*") for line in p.read_text().splitlines())


def make_filing(i):
    rnd = random.Random(i)
    para = lambda: " ".join(f"Fact {rnd.randrange(9999)} about topic {rnd.randrange(9999)} grew by {rnd.randrange(99)} percent." for _ in range(40))
    return (f"<html><body><p>Item 1. Business</p><p>{para()}</p>{TABLE}<p>Item 7. Management</p><p>{para()}</p>"
            f"<p>Item 8. Financial Statements</p><p>{para()}</p></body></html>")


def test_whole_run_supplement_cleanup_and_stream(spark, tmp_path):
    folder = tmp_path / "filings"
    folder.mkdir()
    for i in range(2):
        (folder / f"10k_{i}_0.htm").write_text(make_filing(i), encoding="utf-8")
    assert fl.cached_filing(spark, str(folder), "1").endswith("10k_1_0.htm")
    assert fl.cached_filing(spark, str(folder), "5") is None
    filings = fl.read_filings(spark, str(folder))
    run = bd.Run(str(tmp_path / "stages"), str(tmp_path / "out"), OfflineProvider)
    result = bd.build_dataset(spark, filings, run)
    assert result["raw"] > 0 and result["raw"] == result["verified"] == result["removed"] + result["final"]
    report = (tmp_path / "out" / "quality_report.md").read_text(encoding="utf-8")
    assert f"| In the dataset | {result['final']} |" in report
    stored = ds.read_qa_pairs(spark, str(tmp_path / "out" / "qa_pairs.csv"))
    assert stored.count() == result["final"]

    done = mt.cleanup_dataset(spark, str(tmp_path / "out" / "qa_pairs.csv"), str(tmp_path / "clean"), str(tmp_path / "clean-stages"))
    assert done["rows"] == result["final"]
    predictions = stored.select("question", F.col("ground_truth_answer").alias("predicted_answer"))
    ds.write_csv(predictions, str(tmp_path / "pred"))
    text = mt.format_scores(mt.score_files(spark, str(tmp_path / "clean" / "qa_pairs.csv"), str(tmp_path / "pred")))
    questions = Counter(r["question"] for r in stored.collect())  # a question of both filings meets both answers
    assert f"Overall ({sum(n * n for n in questions.values())} questions): " in text

    generation = st.load_stage(spark, run.stage_dir, "generation")
    earlier = str(tmp_path / "earlier")
    st.save_stage(generation.where("section <> 'Item 7: MD&A'"), earlier, "generation")
    more = bd.supplement_dataset(spark, filings, bd.Run(str(tmp_path / "stages2"), str(tmp_path / "out2"), OfflineProvider), earlier)
    assert more["raw"] == result["raw"]

    target, progress = str(tmp_path / "chunks"), str(tmp_path / "progress")
    ingest(spark, str(folder), target, progress)
    first = spark.read.parquet(target).count()
    assert first == bd.filing_chunks(filings).count() > 0
    ingest(spark, str(folder), target, progress)
    assert spark.read.parquet(target).count() == first


def test_no_matching_questions(spark):
    from quaestor.operators import scoring as ev
    truth = spark.createDataFrame([("q", "a", "comparison", "easy")], "question string, ground_truth_answer string, question_type string, difficulty_estimate string")
    pred = spark.createDataFrame([("other", "a")], "question string, predicted_answer string")
    assert ev.overall(ev.collapsed_scores(truth, pred)).first()["total_evaluated"] == 0
    assert ev.matched_count(truth, pred).first()["matched"] == 0
    nulls = spark.createDataFrame([(None, "a", "comparison", "easy")] * 2, truth.schema)
    assert ev.join_predictions(nulls, spark.createDataFrame([(None, "a")] * 3, pred.schema)).count() == 6
    assert ev.overall(ev.collapsed_scores(nulls, spark.createDataFrame([(None, "a")] * 3, pred.schema))).first()["total_evaluated"] == 6


def test_broken_run_is_resumed_and_finished_outputs_are_refused(spark, tmp_path, monkeypatch):
    folder = tmp_path / "filings"
    folder.mkdir()
    (folder / "10k_7_0.htm").write_text(make_filing(7), encoding="utf-8")
    filings, asked = fl.read_filings(spark, str(folder)), []
    base = dict(stage_dir=str(tmp_path / "stages"), output_dir=str(tmp_path / "out"), waves=2)
    plain = ds.write_jsonl
    monkeypatch.setattr(ds, "write_jsonl", lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        bd.build_dataset(spark, filings, bd.Run(provider=OfflineProvider, **base))
    monkeypatch.setattr(ds, "write_jsonl", plain)
    with pytest.raises(FileExistsError):
        bd.build_dataset(spark, filings, bd.Run(provider=lambda: asked.append(1), **base))
    result = bd.build_dataset(spark, filings, bd.Run(provider=OfflineProvider, resume=True, **base))
    assert not asked and result["failed_batches"] == 0
    assert ds.read_qa_pairs(spark, str(tmp_path / "out" / "qa_pairs.csv")).count() == result["final"] > 0
    assert ds.read_jsonl(spark, str(tmp_path / "out" / "qa_pairs.jsonl")).count() == result["final"]
    assert st.load_stage(spark, base["stage_dir"], "rejected").count() == 0


def test_spread_changes_no_rows(spark):
    from quaestor.session import spread
    df = spark.range(100).coalesce(1).withColumn("k", F.col("id") % 7)
    assert sorted(r.id for r in spread(df, "k").collect()) == list(range(100))


def test_download_feeds_a_build_and_is_cached(spark, tmp_path):
    calls = tmp_path / "calls"
    calls.mkdir()

    def fake(url, agent):
        (calls / str(random.random())).write_text(url)
        if "submissions" in url:
            number = re.search(r"CIK0*(\d+)", url)[1]
            form = "10-Q" if number == "9" else "10-K"
            return json.dumps({"name": "N", "filings": {"recent": {"form": [form], "accessionNumber": [f"0-{number}"], "primaryDocument": ["a.htm"]}}})
        if "/0000000008/" in url:
            raise OSError("HTTP 404")
        return make_filing(3)
    companies = spark.createDataFrame([("3",), ("8",), ("9",), ("5",)], "cik string")
    data = tmp_path / "data"
    data.mkdir()
    (data / "10k_5_x.htm").write_text(make_filing(5), encoding="utf-8")
    failed = {r["cik"]: r["error"] for r in fl.download(spark, str(data), companies, fetch=fake, pause=0.0).collect()}
    assert failed == {"8": "HTTP 404", "9": "no annual report in the index"}
    first = len(list(calls.iterdir()))
    assert first == 5 and not any("0000000005" in p.read_text() for p in calls.iterdir())
    ours = companies.where("cik IN ('3', '5')")
    stored = fl.stored_filings(spark, str(data), ours)
    assert {r["file"].split("/")[-1] for r in stored.collect()} == {"10k_3_0-3.htm", "10k_5_x.htm"}
    result = bd.build_dataset(spark, stored, bd.Run(str(tmp_path / "stages"), str(tmp_path / "out"), OfflineProvider))
    assert result["final"] > 0
    assert fl.download(spark, str(data), ours, fetch=fake, pause=0.0).count() == 0
    assert len(list(calls.iterdir())) == first

from __future__ import annotations

import datetime as dt
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from support import values

from siltstone.functions import decisions as d
from siltstone.operators import sentence_walk, summarise
from siltstone.plans import decisions

DOCUMENT = """Direktori Putusan
putusan.mahkamahagung.go.id
P U T U S A N
Nomor : 12/Pid.B/2024/PN Smr
1. Nama lengkap : BUDI O'neil bin Sam;
2. Tempat lahir : Bandung;
3. Umur/Tanggal lahir : 44 tahun/10 Januari 1980;
4. Jenis kelamin : Laki-laki;
5. Kebangsaan/Kewarganegaraan : Indonesia;
6. Tempat tinggal : Jalan Merdeka Kota Samarinda;
7. Agama : Islam;
8. Pekerjaan : Swasta. 9. Pendidikan : SMA;
Terdakwa ditahan oleh Penyidik
Halaman 1

Disclaimer
Kepaniteraan, telp 021-384 3348 (ext.318)

Menimbang Pasal 303  ayat (1) KUHP, jo. Undang-Undang Nomor 8 Tahun 1981 tentang KUHAP; KUHP Pasal 378.
KUHAP Pasal 183 dan PASAL 303 ayat (1) KUHP, lagi.
barang bukti berupa: 1 (satu) buah
  pisau;
Dirampas untuk dimusnahkan
M E N G A D I L I :
1. Menyatakan bersalah;
demikianlah DIPUTUSKAN dalam rapat
demikianlah"""


@pytest.fixture
def cleaned(spark):
    docs = spark.createDataFrame([(1, DOCUMENT), (2, "tanpa apa pun"), (3, "")], "doc_id long, text string")
    return decisions.clean_documents(docs)


def field(cleaned, column, doc=1):
    return cleaned.where(f"doc_id = {doc}").select(column.alias("x")).first()["x"]


def test_clean_document(cleaned):
    text = field(cleaned, F.col("clean_text"))
    assert text.startswith("P U T U S A N\nNomor : 12")
    assert "Disclaimer" not in text and "Halaman" not in text and "\n\n" not in text
    assert field(cleaned, F.col("clean_text"), 2) == "tanpa apa pun"


def test_single_fields(cleaned):
    text = F.col("clean_text")
    assert field(cleaned, d.decision_number(text)) == "12/Pid.B/2024/PN Smr"
    assert field(cleaned, d.evidence_text(text)) == "1 (satu) buah pisau;"
    # The closing phrase must start a line in just this wording, in any case.
    assert field(cleaned, d.ruling_text(text)) == "1. Menyatakan bersalah;"
    for extract in (d.decision_number, d.evidence_text, d.ruling_text, d.legal_references):
        assert field(cleaned, extract(text), 2) is None
        assert field(cleaned, extract(text), 3) is None


def test_legal_references_equal_pythons_regex(cleaned):
    text = field(cleaned, F.col("clean_text"))
    found = [" ".join(m.group(0).split()) for p in d.REFERENCES for m in re.finditer(p, text, re.IGNORECASE)]
    assert field(cleaned, d.legal_references(F.col("clean_text"))) == ", ".join(dict.fromkeys(found))


def test_references_match_unicode_whitespace(spark):
    rows = spark.createDataFrame([("Pasal 303",), ("pasal\n12a",)], "t string")
    assert values(rows.select(d.legal_references(F.col("t")))) == [("Pasal 303",), ("pasal 12a",)]


def test_biodata(cleaned):
    row = decisions.biodata(cleaned).where("doc_id = 1").first().asDict()
    assert row["nama_terdakwa"] == "Budi O'Neil Bin Sam"
    assert row["tempat_lahir_terdakwa"] == "bandung"
    assert row["tanggal_lahir_terdakwa"] == dt.date(1980, 1, 10)
    assert row["jenis_kelamin_terdakwa"] == "laki-laki"
    assert row["kebangsaan_terdakwa"] == "indonesia"
    # A block stop word inside a word cuts the value ...
    assert row["tempat_tinggal_terdakwa"] == "jalan merdeka kota s"
    assert row["agama_terdakwa"] == "islam"
    assert row["pekerjaan_terdakwa"] == "swasta"
    # ... unless whole words are asked for.
    whole = decisions.biodata(cleaned, word_boundaries=True).where("doc_id = 1").first()
    assert whole["tempat_tinggal_terdakwa"] == "jalan merdeka kota samarinda"
    empty = decisions.biodata(cleaned).where("doc_id = 2").first().asDict()
    assert empty["nama_terdakwa"] is None and empty["agama_terdakwa"] is None


def test_last_value_given_wins(spark):
    text = "Agama : Islam; Nama : Ani; Agama : Hindu; Agama : ;"
    cleaned = spark.createDataFrame([(1, text)], "doc_id long, clean_text string")
    row = decisions.biodata(cleaned).first()
    assert (row["agama_terdakwa"], row["nama_terdakwa"]) == ("hindu", "Ani")


def test_fields_far_from_the_start(spark):
    """Number and personal data count wherever they stand before the considerations, and not after them."""
    filler = "kata lain lagi " * 400
    text = f"{filler}\nNomor : 12/Pid/2020\n{filler}\n1. Nama lengkap : budi @@agama@@ x;\n2. Agama : Hindu;\nMenimbang Agama : Islam; Nomor : 9"
    cleaned = spark.createDataFrame([(1, text)], "doc_id long, clean_text string")
    row = decisions.biodata(cleaned).first()
    assert row["agama_terdakwa"] == "hindu"
    assert row["nama_terdakwa"] == "Budi @@"
    assert cleaned.select(d.decision_number(F.col("clean_text"))).first()[0] == "12/Pid/2020"


def test_extracts_and_quarantine(spark):
    docs = spark.createDataFrame([(1, DOCUMENT), (2, "tanpa apa pun")], "doc_id long, text string")
    valid, bad = decisions.split_quarantine(decisions.document_extracts(docs))
    assert values(valid, "doc_id") == [(1,)]
    assert values(bad, "doc_id") == [(2,)]
    links = spark.createDataFrame(
        [("12/Pid.B/2024/PN Smr", dt.date(2024, 3, 1)), ("99/X", dt.date(2024, 3, 2))], "no_putusan string, tgl_putusan date"
    )
    rows = {r["no_putusan"]: r for r in decisions.decision_extracts(links, valid, "root", dt.date(2024, 4, 1)).collect()}
    assert rows["12/Pid.B/2024/PN Smr"]["gcs_extract_pdf_path"] == "root/extract/2024/12_Pid.B_2024_PN_Smr.txt"
    assert rows["99/X"]["nama_terdakwa"] is None and rows["99/X"]["gcs_extract_pdf_path"] is None
    assert rows["12/Pid.B/2024/PN Smr"]["summary_extractive_short"]


# ---- pages -----------------------------------------------------------------------------------------

LISTING = """
<div class="other spost clearfix"><div class='small x'>Register : 01-02-2024</div>
<div class="small"><b>Putus</b> : 15-03-2024 &mdash;</div><a href="https://h/direktori/putusan/abc.html"> Putusan PN X <i>Nomor</i> 1/A </a></div>
<div class="spost clearfix"><div class="small">Putus : 31-02-2024</div><a href="/direktori/putusan/d">Nomor 2/B</a></div>
<div class="spost clearfix"><div class="small">Putus : 01-04-2024</div><a href="/direktori/putusan/e">3/C</a></div>
<div class="spost clearfix"><div class="small">Putus : 01-04-2024</div><a href="/other/e">Nomor 4/D</a></div>
<p class="card-text">Maret <span class="badge badge-secondary"> 17 </span></p>
<p class="card-text">April <span class="badge badge-secondary">x</span></p>
<p class="card-text">Semua <span class="badge badge-secondary">99</span></p>
"""


def test_listing_page(spark):
    pages = spark.createDataFrame([(1, LISTING), (2, "<p>nothing</p>")], "page_id long, html string")
    records = decisions.listing_records(pages)
    assert values(records, "no_putusan", "tgl_putusan", "link_page_putusan") == [
        ("1/A", dt.date(2024, 3, 15), "https://h/direktori/putusan/abc.html"),
        ("3/C", dt.date(2024, 4, 1), "/direktori/putusan/e"),
    ]
    assert values(decisions.listing_records(pages, dt.date(2024, 4, 1)), "no_putusan") == [("3/C",)]
    assert values(decisions.listing_totals(pages)) == [(1, 3, 17), (1, 4, 0)]


DETAIL = """<span id="title_pihak">Penuntut:<br>P<br/>Terdakwa:<br/> ANI &amp; CO </span>
<table><tr><td>Nomor</td><td> 1/A </td></tr><tr><td>Nomor</td><td>second</td></tr>
<tr><td>Klasifikasi</td><td><a>Pidana</a> \n <a>Umum</a>  <a>Khusus</a></td></tr><tr><td>Tahun</td><td>2024x</td></tr>
<tr><td>Amar</td><td>Satu;\nDua  tiga</td></tr><tr><td>Tanggal Register</td><td> 3 Nopember 2023 </td></tr>
<tr><td>Tanggal Dibacakan</td><td>3 Foo 2023</td></tr></table>
<div class="card-body bg-white"><a href="/zip">z</a><a href="/pdf">p</a></div>"""


def test_detail_page(spark):
    pages = spark.createDataFrame([(1, "u", DETAIL), (2, "v", "<p/>")], "page_id long, url string, html string")
    rows = {r["page_id"]: r.asDict() for r in decisions.detail_fields(pages).collect()}
    got = rows[1]
    assert got["nama_terdakwa"] == "ANI & CO"
    assert got["no_putusan"] == "1/A"
    assert got["klasifikasi"] == "Pidana - Umum - Khusus"
    assert got["tahun"] is None
    assert got["amar"] == "Satu;\nDua tiga"
    assert got["tgl_register"] == dt.date(2023, 11, 3)
    assert got["tgl_dibacakan"] is None
    assert got["link_pdf_putusan"] == "/pdf"
    assert rows[2]["link_pdf_putusan"] == "no_pdf_file" and rows[2]["no_putusan"] is None


# ---- summaries -------------------------------------------------------------------------------------


def dense_scores(sentences: list[str], iterations: int, damping: float) -> np.ndarray:
    """The same walk on the full similarity matrix."""
    bags = [Counter(re.findall(r"[^\W_]+", s.lower())) for s in sentences]
    n = len(sentences)
    document_frequency = Counter(w for b in bags for w in b)
    vocabulary = {w: i for i, w in enumerate(document_frequency)}
    a = np.zeros((n, max(len(vocabulary), 1)))
    for i, bag in enumerate(bags):
        for word, tf in bag.items():
            a[i, vocabulary[word]] = tf * math.log(n / document_frequency[word])
    norms = np.linalg.norm(a, axis=1, keepdims=True)
    a = np.divide(a, norms, out=np.zeros_like(a), where=norms > 0)
    similarity = a @ a.T
    degree = similarity.sum(axis=1)
    transition = np.divide(similarity, degree[:, None], out=np.zeros_like(similarity), where=degree[:, None] > 0)
    p = np.full(n, 1 / n)
    for _ in range(iterations):
        p = (1 - damping) / n + damping * (transition.T @ p)
    return p


TEXTS = {
    1: "Saya makan nasi. Saya makan ikan! Ikan itu besar? Nasi putih dan ikan besar.\n\nBaris baru tanpa titik\n\n...",
    2: "Hanya satu kalimat.",
    3: "!!! ... ???",
    4: "Sama saja. Sama saja. Sama saja. Lain lagi di sini.",
    5: " ".join(f"Kata{i % 17} kata{i % 5} kata{i % 3} dan x{i}." for i in range(300)),
}


def test_scores_match_the_full_matrix(spark):
    docs = spark.createDataFrame(list(TEXTS.items()) + [(6, ""), (7, None)], "doc_id long, text string")
    split = {
        r["doc_id"]: r["s"] for r in docs.select("doc_id", summarise.sentences_of(F.col("text")).alias("s")).collect()
    }
    assert split[1] == [
        "Saya makan nasi.",
        "Saya makan ikan!",
        "Ikan itu besar?",
        "Nasi putih dan ikan besar.",
        "Baris baru tanpa titik",
        "...",
    ]
    got = {r["doc_id"]: r["scores"] for r in summarise.sentence_scores(docs, "doc_id", "text").collect()}
    assert set(got) == set(TEXTS)
    for key in TEXTS:
        expected = dense_scores(split[key], 400, summarise.DAMPING)
        assert np.allclose(got[key], expected, atol=1e-12)


def test_summary_properties(spark):
    docs = spark.createDataFrame(list(TEXTS.items()), "doc_id long, text string")
    top = {r["doc_id"]: r["chosen"] for r in summarise.top_sentences(docs, "doc_id", "text", 2).collect()}
    for key, chosen in top.items():
        positions = [c["position"] for c in chosen]
        assert positions == sorted(positions) and len(positions) <= 2
        assert all(c["sentence"] in re.sub(r"\s+", " ", TEXTS[key]) for c in chosen)
    # Equal sentences tie; the earlier ones are taken.
    assert [c["position"] for c in top[4]] == [0, 1]
    summary = {r["doc_id"]: r["summary"] for r in summarise.summaries(docs, "doc_id", "text", 2).collect()}
    assert summary[2] == "Hanya satu kalimat."


def test_rows_score_like_arrays(spark):
    """The walk over rows gives the scores of the full matrix, each document resting in its own round."""
    docs = spark.createDataFrame(list(TEXTS.items()) + [(6, ""), (7, None)], "doc_id long, text string")
    rows = sentence_walk.sentence_rows(docs, "doc_id", summarise.sentences_of(F.col("text")))
    matrix, _ = sentence_walk.term_matrix(rows, "doc_id")
    assert "collect_list" not in matrix._jdf.queryExecution().executedPlan().toString()
    got = defaultdict(dict)
    for r in sentence_walk.walk_scores(rows, "doc_id", 1e-11, summarise.DAMPING).collect():
        got[r["doc_id"]][r["position"]] = r["score"]
    arrays = {r["doc_id"]: r["scores"] for r in summarise.sentence_scores(docs, "doc_id", "text").collect()}
    assert set(got) == set(arrays)
    for key, scores in arrays.items():
        assert sorted(got[key]) == list(range(len(scores)))
        assert np.allclose([got[key][k] for k in range(len(scores))], scores, atol=1e-10)
    assert sentence_walk.rounds_needed(1e-13, 0.85) < 40


def test_large_documents_are_summarised_alike(spark, monkeypatch):
    docs = spark.createDataFrame(list(TEXTS.items()) + [(6, ""), (7, None)], "doc_id long, text string")
    want = values(summarise.summaries(docs, "doc_id", "text", 3, 1e-9))
    monkeypatch.setattr(summarise, "by_size", lambda d, text: (d.where("doc_id in (2, 6, 7)"), d.where("doc_id not in (2, 6, 7)")))
    assert values(summarise.summaries(docs, "doc_id", "text", 3, 1e-9)) == want


def test_sizes_part_documents(spark):
    docs = spark.createDataFrame([(1, "a" * 50), (2, "b"), (3, None)], "doc_id long, text string")
    small, large = summarise.by_size(docs, "text", 10)
    assert values(small, "doc_id") == [(2,), (3,)] and values(large, "doc_id") == [(1,)]
    assert summarise.by_size(docs, "text", 50)[1] is None


def test_keyword_sentences(spark):
    rows = spark.createDataFrame(
        [("Ini Putusan hakim. Cuaca cerah. Pidana berat.",), ("Cuaca cerah. Hari baik.",)], "s string"
    )
    got = values(rows.select(summarise.keyword_sentences(F.col("s"))))
    assert got == [("Cuaca cerah. Hari baik.",), ("Ini Putusan hakim\nPidana berat.",)]


def test_text_is_split_once_and_shuffled_once(spark, tmp_path):
    path = str(tmp_path / "docs")
    spark.createDataFrame(list(TEXTS.items()), "doc_id long, text string").write.parquet(path)
    rows = summarise.sentence_scores(spark.read.parquet(path), "doc_id", "text")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "Filter ((size(" not in plan


def test_scores_need_no_groups_and_no_joins(spark, tmp_path):
    """The words stay in their document's row; a row is summarised by itself, also where parts of a batch are small."""
    path = str(tmp_path / "docs")
    docs = spark.createDataFrame([*TEXTS.items(), (6, ""), (7, None), (None, "Satu. Dua.")], "doc_id long, text string")
    docs.write.parquet(path)
    top = summarise.top_sentences(spark.read.parquet(path), "doc_id", "text", 2, large=False)
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan and "Join" not in plan and plan.count("Exchange") == 1
    assert {r["doc_id"] for r in top.collect()} == set(TEXTS)
    terms = summarise.document_terms(docs, "text", ["doc_id"]).select("terms").toArrow()["terms"].combine_chunks()
    whole, parts = (summarise.walk(1e-13, 0.85, size)(terms).to_pylist() for size in (10**6, 1))
    assert [len(a) for a in whole] == [len(a) for a in parts]
    assert all(np.allclose(a, b, atol=1e-12) for a, b in zip(whole, parts))


def test_extracts_read_a_text_once(spark, tmp_path):
    """Fields and summary come from one row, so no join by document follows; ids may be missing or come twice, texts empty."""
    path = str(tmp_path / "documents")
    text = "Nomor : 1/Pid\n1. Nama lengkap : budi;\n2. Tempat lahir : kota;\nMenimbang, bahwa pidana itu. Amar putusan."
    spark.createDataFrame([(1, text), (1, text), (2, ""), (3, None), (None, text)], "doc_id long, text string").write.parquet(path)
    out = decisions.document_extracts(spark.read.parquet(path))
    plan = out._jdf.queryExecution().executedPlan().toString()
    # One exchange of the texts, one of the records.
    assert "Join" not in plan and "HashAggregate" not in plan and plan.count("Exchange hashpartitioning") == 2
    rows = values(out, "doc_id", "no_putusan", "nama_terdakwa", "is_valid")
    assert sorted(rows, key=repr) == sorted([(1, "1/Pid", "Budi", True)] * 4 + [(2, None, None, False), (3, None, None, False), (None, "1/Pid", "Budi", True)], key=repr)
    assert {r["doc_id"]: bool(r["summary_extractive_short"]) for r in out.collect()} == {1: True, 2: False, 3: False, None: False}

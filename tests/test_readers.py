"""Documents read at record bounds, whatever the splits."""

import json
import random

import pytest
from pyspark.sql import functions as F

from tieproof.session import scratch
from tieproof.sources import readers, writers


def documents(folder, rnd):
    odd = ["plain", "a } b", '" { "', "\\", "\\\"}", "[{", "", "new\nline", "]}"]

    def record(i):
        return {"company_name": f"Firm {i % 40}", "rec_seq": i, "note": rnd.choice(odd),
                "more": rnd.choice([None, {"deep": [1, {"x": "}"}], "s": rnd.choice(odd)}, []])}

    rows = [[record(100 * d + i) for i in range(n)] for d, n in enumerate((90, 70, 50, 1, 0))]
    whole = [rows[0], {"records": rows[1], "count": {"of": "}"}}, {f"{r['note']}{i}": r for i, r in enumerate(rows[2])}, rows[3], rows[4]]
    for d, doc in enumerate(whole):
        (folder / f"{d}.json").write_text(json.dumps(doc, indent=(None, 1)[d % 2], ensure_ascii=False))
    return rows


@pytest.mark.parametrize("split", ["64", "1000", "100000000"])
def test_documents_are_read_by_many_tasks(spark, tmp_path, split):
    rows = documents(tmp_path, random.Random(4))
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for k in old:
            spark.conf.set(k, split)
        got = readers.split_records(spark, str(tmp_path)).collect()
        last = readers.read_records(spark, str(tmp_path), "rec_seq:bigint,company_name:string,note:string").collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    for d, want in enumerate(rows):
        mine = sorted((r.pos, r.json) for r in got if r.doc_no.endswith(f"/{d}.json"))
        assert [json.loads(j) for _, j in mine] == want
    want = {r["company_name"].lower(): (r["rec_seq"], r["note"]) for doc in rows for r in doc}
    assert {r.name_key: (r.rec_seq, r.note) for r in last} == want


def test_pages_in_one_file_and_in_many(spark, tmp_path):
    pages = ["URL: https://a.org/x\nCAPTURED: 2024-01-02T03:04:05\n\nBody } of\n\npage", "no header", "URL: https://b.org\n\nonly text"]
    (tmp_path / "many").mkdir()
    for i, p in enumerate(pages):
        (tmp_path / "many" / f"{i}.txt").write_text(p)
    (tmp_path / "packed.txt").write_text("".join(p + "\x1e" for p in pages))
    read = lambda *a: sorted((r.url, r.text, r.captured_at is None) for r in readers.read_page_cache(spark, *a).collect())
    want = [("https://a.org/x", "Body } of\n\npage", False), ("https://b.org", "only text", True)]
    assert read(str(tmp_path / "many")) == want == read(str(tmp_path / "packed.txt"), "\x1e")


def test_full_csv_reads_back(spark):
    df = spark.createDataFrame([(2, "b, \"B\"", "x;y", "n/a"), (1, "A", "", "yes")], "rec_seq long, company_name string, notes string, is_public string")
    path = scratch(spark)
    writers.write_full_csv(df, path)
    back = spark.read.csv(path, header=True, escape='"').na.fill("")
    assert back.columns == list(writers.FULL_COLUMNS)
    got = [(r["Company Name"], r["Notes"], r["Public Company"]) for r in back.orderBy(F.lower("Company Name")).collect()]
    assert got == [("A", "", "Yes"), ("b, \"B\"", "x;y", "Unknown")]

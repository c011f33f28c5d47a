"""The SQL of op10 on planted IBANs: it has the operator's rule."""

from __future__ import annotations

import duckdb
from pyspark.sql import functions as F

from pcmarts.llm import oracles, queries


def test_sql_and_operator_agree_on_ibans(spark, tmp_path):
    texts = [
        "pay to DE89 3704 0044 0532 0130 00 now", "ES91 2100 0418 4502 0005 1332 BIC: X", "ES91 2100 0418 4502 0005 1332 EUR",
        "é 漢 BE68 5390 0754 7034 2 payments", "GB82WEST12345698765432,GB82 WEST 1234 5698 7654 32 GB82WEST12345698765433", "DE89370400440532013000x DE8937040044053201300",
        "XDE89370400440532013000 AB12DE89370400440532013000", "ZZ89 3704 0044 0532 0130 00 ZZ4412345678901234", "DE89 DE89370400440532013000\nBE68539007547034",
        "mail a.b@c.de ip 1.2.3.4 +49 30 1234567890 4111 1111 1111 1111 NO9386011117947", "", None, "NO93 8601 1117 947 NO93  8601 1117 947",
    ]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.personal_data(spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    want = con.execute(oracles.ORACLES["op10_personal_data"]).df()
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(want.itertuples(index=False, name=None))
    found = {r.doc_id: r.spans.count("iban") for r in got.where(F.col("spans").contains("iban")).collect()}
    assert found[0] == found[1] == found[2] == found[3] == 1 and found[4] == 2 and found[8] == 2 and found[9] == 1 and 5 not in found

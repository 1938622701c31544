"""XML snapshots in one pass: heads, splits, files of any size."""

import pytest
from pyspark.sql import functions as F

from tickweave.sources import xml_states

HEAD = "<?xml version=\"1.0\"?>\n<states>\n<itno> {t} </itno>\n{env}\n"
ENV = "<environment>\n<set_no>{t}</set_no>\n<const_radius>1.5</const_radius>\n</environment>"


def put(path, t, agents, env=ENV):
    body = "".join(f"<xagent>\n<name>{n}</name>\n<id>{i}</id><x>{i}.5</x><note>a &lt; {i}</note>\n</xagent>\n" for i, n in agents)
    path.write_text(HEAD.format(t=t, env=env.format(t=t)) + body + "</states>\n")


def test_one_scan_of_the_files(spark, tmp_path, monkeypatch):
    put(tmp_path / "0.xml", 0, [(i, "Agent") for i in range(5000)] + [(-1, "Bank")])
    put(tmp_path / "10.xml", 10, [(3, "Agent")], env="")
    put(tmp_path / "20.xml", -20, [])
    (tmp_path / "30.xml").write_text("<states><xagent><name>Agent</name><id>9</id></xagent></states>")
    plans = []
    settle = xml_states.settle
    monkeypatch.setattr(xml_states, "settle", lambda df, name: plans.append(df._jdf.queryExecution().executedPlan().toString()) or settle(df, name))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")  # the first file is cut into several tasks
    try:
        for schema in ("name string, id bigint, x double, note string", None):
            df = xml_states.read_xml_snapshots(spark, str(tmp_path / "*.xml"), "Agent", schema, "set_no int, const_radius double" if schema else None)
            rows = {(r.itno, r.id): (r.env and (r.env.set_no, r.env.const_radius), r.x, r.note) for r in df.collect()}
            assert df.count() == len(rows) == 5002
            assert rows[(0, 4999)] == ((0, 1.5), 4999.5, "a < 4999") and rows[(10, 3)][0] is None and rows[(None, 9)] == (None, None, None)
            assert {k[0] for k in rows} == {0, 10, None}
            final = df._jdf.queryExecution().executedPlan().toString()
            assert ".xml" not in final.replace("xml-records", "")  # the files themselves are not read again
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(plans) == 2 and all(p.count("FileScan") == 1 for p in plans)
    assert df.agg(F.max("x")).first()[0] == 4999.5


def test_names_with_blanks_in_schema(spark, tmp_path):
    put(tmp_path / "1.xml", 1, [(1, "Agent")])
    df = xml_states.read_xml_snapshots(spark, str(tmp_path / "1.xml"))
    assert dict(df.dtypes)["env"] == "struct<const_radius:double,set_no:bigint>" and df.first().x == 1.5
    with pytest.raises(Exception):
        xml_states.read_xml_snapshots(spark, str(tmp_path / "none.xml"))

"""Parts-list files through read_bom, and the characters of component names."""

from pyspark.sql import functions as F

from partsieve.functions.rules import component_name
from partsieve.sources.bom import HEADERS, read_bom


def test_all_headers_in_order_of_preference(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Reference,Designator,Name,Description,Qnty,Vendor,Digikey,PCB Footprint\nx,R1,n,10k,2,V,D-1,0603\n,,,,,,,0805\n")
    (tmp_path / "b.tsv").write_text("Parts\tPart Name\tPartNo\nC1\t1uF\tP-9\n")
    rows = {r["path"].rsplit("/", 1)[1]: r.asDict() for r in read_bom(spark, str(tmp_path)).collect()}
    a, b = rows["a.csv"], rows["b.tsv"]
    assert [a[c] for c in HEADERS] == ["R1", "10k", "2", "V", "D-1", None, "0603"]
    assert [b[c] for c in HEADERS] == ["C1", "1uF", None, None, "P-9", None, None]
    assert sum(map(len, HEADERS.values())) == 106


def test_odd_characters(spark):
    names = {"10 ω": "10ohm", "a–b—c": "a-b-c", "3×4": "3x4", "“x” 5′": "\"x\" 5'", "‘q’": "'q'", "—": "", "4.7 µF ±5%": "4.7uf +-5%"}
    rows = spark.createDataFrame(list(names.items()), "raw string, want string").select("want", component_name(F.col("raw")).alias("got")).collect()
    assert [r["got"] for r in rows] == [r["want"] for r in rows]

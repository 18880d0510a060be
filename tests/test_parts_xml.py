"""Parts lists in the four XML dialects."""

from partsieve.sources.bom import HEADERS
from partsieve.sources.parts_xml import read_xml_parts

KICAD = """<?xml version="1.0"?><export version="D"><components><comp ref="R1"><value>10k</value><footprint>R_0603</footprint><mpn>M1</mpn></comp>
<comp ref="C1"><value> </value><fields><field name="MPN">X-2</field><field name="Manufacturer">Acme</field></fields></comp></components></export>"""
FLAT = "<schematic><component><Reference>C1</Reference><Value>100nF</Value><Count>1</Count></component><component><Footprint>x</Footprint></component></schematic>"
EAGLE = """<eagle version="6"><drawing><schematic><parts><part name="U1" value="LM317" device="SO8"><attribute name="MPN" value="LM317T"/></part><part value="no name"/></parts></schematic></drawing></eagle>"""
SHEET = """<?xml version="1.0"?><Workbook xmlns="urn:schemas-microsoft-com:office:spreadsheet" xmlns:ss="urn:schemas-microsoft-com:office:spreadsheet"><Worksheet ss:Name="a"><Table>
<Row><Cell><Data ss:Type="String">Designator</Data></Cell><Cell><Data ss:Type="String">Comment</Data></Cell><Cell><Data ss:Type="String">Quantity</Data></Cell></Row>
<Row><Cell><Data ss:Type="String">J1</Data></Cell><Cell><Data ss:Type="String">USB</Data></Cell><Cell><Data ss:Type="Number">2</Data></Cell></Row></Table></Worksheet></Workbook>"""


def test_dialects(spark, tmp_path):
    (tmp_path / "node_modules").mkdir()
    for name, text in {"k": KICAD, "f": FLAT, "e": EAGLE, "s": SHEET, "bad": "<export><components>", "other": "<root/>", "node_modules/k": KICAD}.items():
        (tmp_path / f"{name}.xml").write_text(text)
    (tmp_path / "u.xml").write_bytes(FLAT.encode("utf-16"))
    got = {}
    for r in read_xml_parts(spark, str(tmp_path)).collect():
        got.setdefault(r["path"].rsplit("/", 1)[1], []).append([r[c] for c in HEADERS])
    assert got["k.xml"] == [["R1", "10k", None, None, "M1", None, "R_0603"], ["C1", None, None, "Acme", "X-2", None, None]]
    assert got["f.xml"] == got["u.xml"] == [["C1", "100nF", "1", None, None, None, None]]
    assert got["e.xml"] == [["U1", "LM317", None, None, "LM317T", None, "SO8"]]
    assert got["s.xml"] == [["J1", "USB", "2", None, None, None, None]]
    assert set(got) == {"k.xml", "f.xml", "u.xml", "e.xml", "s.xml"}

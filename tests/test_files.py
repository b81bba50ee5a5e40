"""Files: Akoma Ntoso parsing, triples, directory trees, and the file stream."""

import json

from billtrace import schemas
from billtrace.functions.bodies import decode_bytes
from billtrace.operators.documents import parse_amendments, parse_bills
from billtrace.plans.acts import act_tables
from billtrace.sources.readers import parse_ntriples
from billtrace.sources import add_path_parts, list_paths, read_documents, read_files, read_ntriples, read_table, write_table
from billtrace.streaming import stream_new_files
from billtrace.streaming.files import to_reparse

NS = 'xmlns="http://docs.oasis-open.org/legaldocml/ns/akn/3.0/CSD03"'
BILL = f"""<akomaNtoso {NS}><bill><meta><identification><FRBRWork><FRBRdate date="2023-01-01"/><FRBRnumber value="7"/>
<FRBRsubtype value="ddl"/></FRBRWork></identification><references><TLCPerson id="p1" showAs="Anna Verdi"/>
<TLCRole id="r1" showAs="Senatrice proponente"/></references></meta><preface><docProponent refersTo="#p1" as="#r1">x</docProponent>
<docProponent refersTo="#p9"> Rossi </docProponent></preface><body><article id="a1"><num>Art. 1.</num>
<heading>Il <i>titolo</i> vero</heading><paragraph><num>1.</num><content><p>1. Testo <b>misto</b> qui</p></content></paragraph>
<paragraph><content><p>Senza numero</p></content></paragraph></article></body></bill></akomaNtoso>"""
AMENDMENT = f"""<akomaNtoso {NS}><amendment><meta><identification><FRBRWork><FRBRthis value="em1"/><FRBRdate date="2023-05-10"/>
<FRBRnumber value="3.1"/><FRBRname value="em"/></FRBRWork></identification><references><activeRef href="/ddl/7" showAs="DDL 7"/>
<TLCPerson id="p1" showAs="Anna Verdi" href="/senatore/22"/></references></meta><preface><p><docNumber> Emendamento n. 3.1 </docNumber></p>
<docProponent refersTo="#p1">x</docProponent><docProponent refersTo="#p5">Bruno</docProponent></preface>
<amendmentBody><p>Al <i>comma</i> 2</p><p> </p></amendmentBody></amendment></akomaNtoso>"""


def corpus(root):
    for kind, name, text in [("ddlpres", "b.akn.xml", BILL), ("emendc", "e.akn.xml", AMENDMENT), ("emendc", "e2.akn.xml", AMENDMENT), ("emendc", "bad.akn.xml", "<akoma")]:
        folder = root / "Leg19" / "Atto1" / kind
        folder.mkdir(parents=True, exist_ok=True)
        (folder / name).write_text(text, encoding="utf-8")
    return str(root)


def test_parse_and_flatten(spark, tmp_path):
    root = corpus(tmp_path)
    bill = parse_bills(read_files(spark, root, "b.akn.xml")).first()
    assert (bill.date, bill.number, bill.type, bill.error) == ("2023-01-01", "7", "ddl", None)
    assert [tuple(p) for p in bill.proponents] == [("p1", "Anna Verdi", "F", True), ("p9", "Rossi", "M", False)]
    article = bill.articles[0]
    assert (article.id, article.num, article.heading) == ("a1", "Art. 1.", "Il titolo vero")
    assert [tuple(p) for p in article.paragraphs] == [("1.", "1. Testo misto qui"), ("", "Senza numero")]

    amendments = parse_amendments(read_files(spark, root + "/Leg19/Atto1/emendc"))
    assert amendments.filter("error is not null").count() == 1
    first = amendments.filter("error is null").first()
    assert (first.id, first.number, first.target_ddl, first.target_info, first.content) == ("em1", "3.1", "/ddl/7", "Emendamento n. 3.1", ["Al comma 2"])
    assert [tuple(p) for p in first.proponents] == [("p1", "Anna Verdi", "/senatore/22"), ("p5", "Bruno", None)]

    persons = spark.createDataFrame(
        [("22", "u", "Anna Verdi", "Anna", "Verdi", "F", None, [("g", "Gruppo", "2022-10-13", None, "G")])], schemas.PERSON
    )
    tables = act_tables(read_files(spark, root, "b.akn.xml"), read_files(spark, root + "/Leg19/Atto1/emendc"), persons)
    assert tables["t_emendamenti"].count() == 1  # two copies of one amendment
    got = sorted(tuple(r) for r in tables["t_proponenti"].select("proponente_id", "proponente_nome", "proponente_gruppo").collect())
    assert got == [("22", "Anna Verdi", "Gruppo")] * 2 + [("p5", "Bruno", None)] * 2  # those of every copy
    article = tables["t_articoli"].first()
    assert article.testo_integrale == "1. Testo misto qui Senza numero"
    assert tables["t_firmatari_atto"].count() == 2
    assert [tuple(r) for r in tables["t_atti"].collect()] == [("Atto1", "19")]


def test_stream_in_two_drops_equals_batch(spark, tmp_path):
    folder, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    folder.mkdir()

    def drop(lo, hi):
        for i in range(lo, hi):
            text = BILL.replace('value="7"', f'value="{i}"') if i % 5 else "<broken"
            (folder / f"{i}.xml").write_text(text, encoding="utf-8")

    def load():
        stream_new_files(spark, str(folder), parse_bills, out, state, "*.xml", max_files=4).awaitTermination()

    drop(0, 7)
    load()
    drop(7, 12)
    load()
    load()  # nothing new
    streamed = spark.read.parquet(out)
    batch = parse_bills(read_files(spark, str(folder), "*.xml"))
    assert streamed.count() == 12 and streamed.filter("error is not null").count() == 3
    assert sorted(map(str, streamed.select("path", "number").collect())) == sorted(map(str, batch.select("path", "number").collect()))


def test_paths_triples_and_round_trips(spark, tmp_path):
    root = corpus(tmp_path / "tree")
    listed = add_path_parts(list_paths(spark, root))
    got = {(r.legislatura, r.atto_id, r.kind, r.file_name) for r in listed.collect()}
    assert (19, "Atto1", "ddlpres", "b.akn.xml") in got and len(got) == 4
    short = spark.createDataFrame([("x/Leg13/Atto2",), ("x/Leg13/README.md",), ("README.md",)], "path string")
    assert [tuple(r)[1:4] for r in add_path_parts(short).collect()] == [(13, "Atto2", None), (13, None, None), (None, None, None)]

    nt = tmp_path / "x.nt"
    nt.write_text(
        '<http://a> <http://p> "uno \\"due\\" \\n tre"@it .\n_:b1 <http://p> <http://o> .\n# note\n\n'
        '<http://a> <http://q> "5"^^<http://int> .\n<http://a> <http://r> _:b1 .\n',
        encoding="utf-8",
    )
    triples = sorted(tuple(r)[:5] for r in read_ntriples(spark, str(nt)).filter("error is null").na.fill("").collect())
    assert triples == [
        ("_:b1", "http://p", "http://o", "iri", ""),
        ("http://a", "http://p", 'uno "due" \n tre', "literal", ""),
        ("http://a", "http://q", "5", "literal", "http://int"),
        ("http://a", "http://r", "_:b1", "bnode", ""),
    ]

    docs = tmp_path / "docs"
    docs.mkdir()
    person = {"id": "1", "full_name": "A B", "gruppi": [{"uri": "g", "nome": "G"}]}
    (docs / "1.json").write_text(json.dumps(person, indent=2), encoding="utf-8")
    assert read_documents(spark, str(docs), schemas.PERSON).first().gruppi[0].nome == "G"

    table = spark.createDataFrame([(1, 'a "b", c\nd'), (2, None)], "n int, t string")
    write_table(table, str(tmp_path / "csv"), fmt="csv")
    back = read_table(spark, str(tmp_path / "csv"), table.schema, "csv", multi_line=True)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, table.collect()))

    parts = str(tmp_path / "parts")
    write_table(spark.createDataFrame([(1, "a"), (2, "b")], "leg int, v string"), parts, partition_by=["leg"])
    write_table(spark.createDataFrame([(2, "z")], "leg int, v string"), parts, partition_by=["leg"])
    assert sorted((r.leg, r.v) for r in spark.read.parquet(parts).collect()) == [(1, "a"), (2, "z")]


def test_literal_escapes_and_broken_lines(spark):
    lines = [
        r'<http://a> <http://p> "C:\\new" .', r'<http://a> <http://p> "citt\u00E0 \U0001F600\r" . # note', r'<http://a> <http://p> "x" ', "  # only a note", "",
    ]
    got = parse_ntriples(spark.createDataFrame([(x,) for x in lines], "value string")).collect()
    assert [(r.o, r.error) for r in got] == [("C:\\new", None), ("citt\u00e0 \U0001f600\r", None), (None, lines[2])]


def test_byte_order_marks(spark):
    raw = [bytearray(b"\xef\xbb\xbf" + "è".encode()), bytearray(b"\xff\xfe" + "è".encode("utf-16-le")), bytearray("è".encode())]
    df = spark.createDataFrame([(r,) for r in raw], "c binary")
    assert [r.t for r in df.select(decode_bytes("c").alias("t")).collect()] == ["è"] * 3


def test_small_outputs_are_parsed_again(spark):
    outputs = spark.createDataFrame([("a", 500), ("b", 10)], "k string, length long")
    sources = spark.createDataFrame([("a",), ("b",), ("c",)], "k string")
    assert sorted(r.k for r in to_reparse(outputs, sources, "k").collect()) == ["b", "c"]

import io
import zipfile


from memweave.operators import render as RD
from memweave.sources import office

W = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
P = ('xmlns:p="http://schemas.openxmlformats.org/presentationml/2006/main" '
     'xmlns:a="http://schemas.openxmlformats.org/drawingml/2006/main" '
     'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"')
S = ('xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" '
     'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"')
REL = 'xmlns="http://schemas.openxmlformats.org/package/2006/relationships"'


def _zip(path, parts):
    with zipfile.ZipFile(path, "w") as z:
        for name, body in parts.items():
            z.writestr(name, body)


def make_docx(path):
    body = (f'<w:document {W}><w:body>'
            '<w:p><w:r><w:t>  First</w:t></w:r><w:r><w:t> line</w:t></w:r></w:p>'
            '<w:tbl><w:tr><w:tc><w:p><w:r><w:t>In table</w:t></w:r></w:p></w:tc></w:tr></w:tbl>'
            '<w:p><w:r><w:t>Last  </w:t></w:r></w:p></w:body></w:document>')
    _zip(path, {"word/document.xml": body})


def make_pptx(path):
    pres = (f'<p:presentation {P}><p:sldIdLst><p:sldId id="256" r:id="rId2"/><p:sldId id="257" r:id="rId1"/>'
            '<p:sldId id="258" r:id="rId3"/></p:sldIdLst></p:presentation>')
    rels = (f'<Relationships {REL}><Relationship Id="rId1" Target="slides/slideB.xml"/>'
            '<Relationship Id="rId2" Target="slides/slideA.xml"/><Relationship Id="rId3" Target="slides/slideC.xml"/>'
            '</Relationships>')

    def slide(texts, show=None):
        attr = f' show="{show}"' if show is not None else ""
        return f'<p:sld {P}{attr}><p:cSld>' + "".join(f"<a:t>{t}</a:t>" for t in texts) + "</p:cSld></p:sld>"

    _zip(path, {"ppt/presentation.xml": pres, "ppt/_rels/presentation.xml.rels": rels,
                "ppt/slides/slideA.xml": slide(["Hello", "world"]), "ppt/slides/slideB.xml": slide(["hidden"], "0"),
                "ppt/slides/slideC.xml": slide(["Third"])})


def make_xlsx(path):
    wb = f'<workbook {S}><sheets><sheet name="S1" sheetId="1" r:id="rId1"/></sheets></workbook>'
    rels = f'<Relationships {REL}><Relationship Id="rId1" Target="worksheets/sheet1.xml"/></Relationships>'
    sst = f'<sst {S}><si><t>name</t></si><si><t>say "hi"</t></si></sst>'
    sheet = (f'<worksheet {S}><sheetData>'
             '<row r="1"><c r="A1" t="s"><v>0</v></c><c r="B1"><v>1.5</v></c></row>'
             '<row r="2"><c r="A2" t="s"><v>1</v></c><c r="B2"/><c r="C2"><v>7</v></c></row>'
             '</sheetData></worksheet>')
    _zip(path, {"xl/workbook.xml": wb, "xl/_rels/workbook.xml.rels": rels, "xl/sharedStrings.xml": sst,
                "xl/worksheets/sheet1.xml": sheet})


def test_word_paragraphs_to_text(spark, tmp_dir):
    make_docx(f"{tmp_dir}/a.docx")
    paras = office.read_word(spark, tmp_dir)
    assert [r.text for r in paras.orderBy("pos").collect()] == ["  First line", "In table", "Last  "]
    text = RD.paragraphs_to_text(paras).first().text
    assert text == "First line\nIn table\nLast"


def test_slides_hidden_keeps_numbering(spark, tmp_dir):
    make_pptx(f"{tmp_dir}/d.pptx")
    rows = office.read_slides(spark, tmp_dir)
    text = RD.slides_to_text(rows).first().text
    assert text == "# Slide 1\nHello world\n# Slide 3\nThird"
    shown = RD.slides_to_text(rows, skip_hidden=False, with_end_marker=True).first().text
    assert "# Slide 2\nhidden\n# End of slide 2" in shown


def test_sheet_blank_cell_shifts_left(spark, tmp_dir):
    make_xlsx(f"{tmp_dir}/b.xlsx")
    cells = office.read_cells(spark, tmp_dir)
    text = RD.cells_to_text(cells).first().text
    assert text == '# Worksheet 1\n\n"name", 1.5\n"say ""hi""", 7'


def test_empty_sheet_renders_header_only(spark, tmp_dir):
    wb = (f'<workbook {S}><sheets><sheet name="S1" sheetId="1" r:id="rId1"/>'
          '<sheet name="S2" sheetId="2" r:id="rId2"/></sheets></workbook>')
    rels = (f'<Relationships {REL}><Relationship Id="rId1" Target="worksheets/sheet1.xml"/>'
            '<Relationship Id="rId2" Target="worksheets/sheet2.xml"/></Relationships>')
    sheet1 = f'<worksheet {S}><sheetData><row r="1"><c r="A1"><v>3</v></c></row></sheetData></worksheet>'
    sheet2 = f'<worksheet {S}><sheetData/></worksheet>'
    _zip(f"{tmp_dir}/e.xlsx", {"xl/workbook.xml": wb, "xl/_rels/workbook.xml.rels": rels,
                               "xl/worksheets/sheet1.xml": sheet1, "xl/worksheets/sheet2.xml": sheet2})
    text = RD.cells_to_text(office.read_cells(spark, tmp_dir), sheets=office.read_sheets(spark, tmp_dir),
                            with_end_marker=True).first().text
    assert text == ("# Worksheet 1\n\n3\n\n# End of worksheet 1\n\n# Worksheet 2\n\n\n"
                    "# End of worksheet 2")


def test_office_to_text_all_formats(spark, tmp_dir):
    make_docx(f"{tmp_dir}/a.docx")
    make_pptx(f"{tmp_dir}/d.pptx")
    make_xlsx(f"{tmp_dir}/b.xlsx")
    assert office.office_to_text(spark, tmp_dir).count() == 3


def test_missing_body_is_error():
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        z.writestr("word/other.xml", "<x/>")
    try:
        office.word_paragraphs(buf.getvalue())
    except office.OfficeFormatError:
        return
    raise AssertionError("expected an error")


def test_paginate(spark):
    df = spark.createDataFrame([(1, "\n".join(str(i) for i in range(5)))], "doc_id long, text string")
    pages = RD.paginate(df, lines_per_page=2).orderBy("page_no").collect()
    assert [(p.page_no, p.text) for p in pages] == [(1, "0\n1"), (2, "2\n3"), (3, "4")]


def test_batches_of_files_are_parsed_in_slices(tmp_dir):
    import pyarrow as pa

    path = f"{tmp_dir}/a.pptx"
    make_pptx(path)
    data = open(path, "rb").read()
    batch = pa.RecordBatch.from_pydict({"path": [f"f{i}" for i in range(600)], "content": [data] * 600})
    out = list(office._files_to_rows("slides")(iter([batch])))
    one = office.slide_texts(data)
    per_file = sum(len(texts) for _n, texts, _h in one)
    assert [len(set(b.column("doc").to_pylist())) for b in out] == [256, 256, 88]
    assert sum(b.num_rows for b in out) == 600 * per_file
    first = out[0].slice(0, per_file).to_pylist()
    assert [(r["slide_no"], r["pos"], r["text"], r["hidden"]) for r in first] == [(n, i, t, h) for n, texts, h in one for i, t in enumerate(texts)]

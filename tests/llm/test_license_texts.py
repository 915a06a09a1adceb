from weftline.llm import license_scan


def test_whole_texts_are_known(spark):
    texts = {p.stem: p.read_text("utf-8") for p in license_scan.TEXTS.glob("*.txt")}
    assert {"Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0", "CC0-1.0", "BSD-2-Clause", "BSD-3-Clause", "Unlicense"} <= texts.keys()
    mit, isc = license_scan.KNOWN["MIT"][1], license_scan.KNOWN["ISC"][0]
    rows = [*texts.items(), ("MIT", f"MIT License\n\nCopyright (c) 2020 Someone\n\n{mit}"), ("ISC", f"ISC License\n\nCopyright (c) 2020 Someone\n\n{isc}")]
    rows += [("BSD-3-Clause", "BSD 3-Clause License\n\nCopyright (c) 2020, Someone\n\n" + texts["BSD-3-Clause"]), ("GPL-3.0", texts["GPL-3.0"].split("\n", 2)[2].lstrip())]
    rows += [("Apache-2.0", texts["Apache-2.0"].split("APPENDIX")[0]), (None, texts["GPL-3.0"] + "\nand more")]
    docs = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(rows)], "doc_id long, text string")
    got = {r.doc_id: r.license_id for r in license_scan.scan(docs, license_scan.registry(spark)).collect()}
    assert [got[i] for i in range(len(rows))] == [k for k, _ in rows]

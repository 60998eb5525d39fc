import os
import zipfile

import pytest
from pyspark.sql import functions as F

from peakloom.sinks import files
from peakloom.sources import delimited, xml


def test_delimited(spark, tmp_path):
    p = tmp_path / "a_____qvalue_no_decoys_fdr_0.01.tsv"
    p.write_text('plain_peptide\tscan\textra\tqvalue\n"PE""P"\t7\tx\t1e-3\nTIDE\tbad\ty\t\n')
    rows = delimited.delimited(spark, str(p), delimited.PSMS).orderBy("ordinal").collect()
    assert [(r.run, r.fdr, r.scan, r.qvalue, r.plain_peptide, r.peptide_seq) for r in rows] == [("a", "0.01", 7, 0.001, 'PE"P', None), ("a", "0.01", None, None, "TIDE", None)]
    assert [(r.run, r.kind) for r in delimited.manifest(spark, str(tmp_path / "*.tsv")).collect()] == [("a_____qvalue_no_decoys_fdr_0.01", "tsv")]


def test_parameters_and_fasta(spark, tmp_path):
    (tmp_path / "p.txt").write_text("# c\nnum_threads = 0   # all\ndatabase_name = a b.fasta\n[ENZYME]\n1. Trypsin 1 KR P\n")
    assert {r.name: r.value for r in delimited.search_parameters(spark, str(tmp_path / "p.txt")).collect()} == {"num_threads": "0", "database_name": "a b.fasta"}
    (tmp_path / "s.txt").write_text("a = 1\n[ENZYME]  \n0. None 0 - -\n1. Trypsin 1 KR P # cuts\n\n[OTHER]\nx [y]\n")
    assert [tuple(r) for r in delimited.parameter_sections(spark, str(tmp_path / "s.txt")).orderBy("section", "nth").collect()] == [("ENZYME", 0, "0. None 0 - -"), ("ENZYME", 1, "1. Trypsin 1 KR P"), ("OTHER", 0, "x [y]")]
    (tmp_path / "e.dat").write_text("ID   A_HUMAN  Reviewed; 4 AA.\nAC   P1; P2;\nDE   RecName: Full=Some protein;\nSQ   SEQUENCE   4 AA;\n     MKLV  \n//\nID   B\nAC   Q9;\nSQ   SEQUENCE\n     MKLVA AAAAA\n     GG\n//\n")
    assert [tuple(r) for r in delimited.sp_embl(spark, str(tmp_path / "e.dat")).orderBy("entry").collect()] == [("A_HUMAN", "P1", "RecName: Full=Some protein;", "MKLV"), ("B", "Q9", "", "MKLVAAAAAAGG")]
    (tmp_path / "f.fasta").write_text(">sp|A\nMK\nLV\n>sp|B\nM\n")
    assert {r.header: r.sequence for r in delimited.fasta(spark, str(tmp_path / "f.fasta")).collect()} == {"sp|A": "MKLV", "sp|B": "M"}


def test_round_trip_of_text(spark, tmp_path):
    df = spark.createDataFrame([("f_1", [1, 2], 'a "q"')], "openms_fid string, l_ms2_scans array<int>, l_pep_ident string")
    files.delimited(df, str(tmp_path / "out"))
    back = delimited.delimited(spark, str(tmp_path / "out"), delimited.EXPORTED).first()
    assert (back.openms_fid, back.l_ms2_scans, back.l_pep_ident) == ("f_1", "[1,2]", 'a "q"')
    files.parquet(df.selectExpr("*", "'0.01' AS fdr"), str(tmp_path / "pq"))
    assert (tmp_path / "pq" / "fdr=0.01").is_dir()


MZML = """<?xml version="1.0"?><mzML xmlns="http://psi.hupo.org/ms/mzml"><run><spectrumList>
<spectrum id="controllerType=0 controllerNumber=1 scan=5"><cvParam accession="MS:1000511" name="ms level" value="2"/>
<scanList><scan><cvParam accession="MS:1000016" name="scan start time" value="2.5" unitName="minute"/></scan></scanList>
<precursorList><precursor><selectedIonList><selectedIon><cvParam accession="MS:1000744" name="m" value="500.5"/><cvParam accession="MS:1000041" name="z" value="3"/></selectedIon></selectedIonList></precursor></precursorList></spectrum>
<spectrum id="scan=6"><cvParam accession="MS:1000511" name="ms level" value="1"/></spectrum></spectrumList></run></mzML>"""
CONSENSUS = """<consensusXML><mapList count="2"><map id="0" name="x/run1.mzML"/><map id="1" name="run2.mzML"/></mapList><consensusElementList>
<consensusElement id="e_7"><groupedElementList><element map="0" id="11"/><element map="1" id="12"/></groupedElementList></consensusElement></consensusElementList></consensusXML>"""
TRAFO = '<TrafoXML><Transformation name="x"><Pairs count="2"><Pair from="1.5" to="2.5"/><Pair from="3" to="4"/></Pairs></Transformation></TrafoXML>'
FEATURE = """<featureMap><featureList><feature id="f_1"><position dim="0">10.5</position><position dim="1">500</position><intensity>9</intensity><charge>2</charge>
<convexhull nr="0"><pt x="1" y="5"/><pt x="3" y="4"/></convexhull><convexhull nr="1"><pt x="2" y="6"/></convexhull><UserParam type="string" name="n" value="v"/></feature></featureList></featureMap>"""


def test_xml(spark, tmp_path):
    for name, text in (("r1.mzML", MZML), ("c.consensusXML", CONSENSUS), ("a_____x.trafoXML", TRAFO), ("r1.featureXML", FEATURE)):
        (tmp_path / name).write_text(text)
    assert [tuple(r) for r in xml.ms2_scans(spark, str(tmp_path / "r1.mzML")).collect()] == [("r1", 5, 150.0, 500.5, 3)]
    assert sorted(tuple(r) for r in xml.consensus_edges(spark, str(tmp_path / "c.consensusXML")).collect()) == [("e_7", "run1", "f_11"), ("e_7", "run2", "f_12")]
    assert sorted(tuple(r) for r in xml.transformations(spark, str(tmp_path / "*.trafoXML")).collect()) == [("a", 1.5, 2.5), ("a", 3.0, 4.0)]
    f = xml.features(spark, str(tmp_path / "r1.featureXML")).first()
    assert (f.run, f.feature_id, f.rt, f.mz, f.charge, [tuple(h) for h in f.hulls]) == ("r1", "f_1", 10.5, 500.0, 2, [(1.0, 3.0, 4.0, 5.0), (2.0, 2.0, 6.0, 6.0)])
    files.feature_xml(xml.features(spark, str(tmp_path / "r1.featureXML")), str(tmp_path / "back"))
    again = xml.features(spark, str(tmp_path / "back")).first()
    assert (again.mz, again.hulls) == (500.0, f.hulls)


def test_identifications_in_feature_xml(spark, tmp_path):
    kind = "rt double, mz double, score_type string, proteins string, hits array<struct<score: double, sequence: string, charge: int, raw_peptide: string>>"
    ident = (1.5, 400.0, "q-value", "P1,P2", [(0.01, "PEPTIDE", 2, "PEP[+16]TIDE")])
    f = spark.createDataFrame([("f_1", 10.0, 500.0, 7.0, 2, [ident, ident]), ("f_2", 11.0, 501.0, 8.0, None, [])], f"feature_id string, rt double, mz double, intensity double, charge int, idents array<struct<{kind.replace(' ', ':', 1)}>>".replace("rt:double, mz double, score_type string, proteins string, hits array", "rt: double, mz: double, score_type: string, proteins: string, hits: array"))
    files.feature_xml(f, str(tmp_path / "x"), spark.createDataFrame([ident], kind))
    got = {r.feature_id: r for r in xml.features(spark, str(tmp_path / "x")).collect()}
    plain = lambda i: (i.rt, i.mz, i.score_type, i.proteins, [tuple(h) for h in i.hits])
    assert [plain(i) for i in got["f_1"].idents] == [ident, ident] and not got["f_2"].idents
    assert [plain(r) for r in xml.unassigned(spark, str(tmp_path / "x-unassigned")).collect()] == [ident]


def test_headers_of_several_files(spark, tmp_path):
    (tmp_path / "a_____fdr_0.01.tsv").write_text("scan\tpeptide_seq\tqvalue\n" + "".join(f"{k}\tP{k}\t0.1\n" for k in range(5000)))
    (tmp_path / "b_____fdr_0.05.tsv").write_text("qvalue\tmodified_peptide\tscan\n0.2\tM\t9\n")
    (tmp_path / "c_____fdr_0.05.tsv").write_text("")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        df = delimited.delimited(spark, str(tmp_path), delimited.PSMS)
        assert df.where("run = 'a'").rdd.getNumPartitions() > 3
        assert [r.scan for r in df.where("run = 'a'").orderBy("ordinal").collect()] == list(range(5000))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [(r.fdr, r.scan, r.qvalue, r.peptide_seq, r.modified_peptide) for r in df.where("run = 'b'").collect()] == [("0.05", 9, 0.2, None, "M")]
    assert delimited.delimited(spark, str(tmp_path / "c*"), delimited.PSMS).count() == 0


def test_directories(spark, tmp_path):
    (tmp_path / "r1.d").mkdir()
    (tmp_path / "r2.d").write_text("a file")
    assert [(r.run, r.kind) for r in delimited.directories(spark, str(tmp_path / "*.d")).collect()] == [("r1", "d")]


def test_xlsx(spark, tmp_path):
    kind = "openms_ceid string, r1_____intensity double, r2_____intensity double, r1_____l_pep_ident string, first_iso_global_min_mz double"
    df = spark.createDataFrame([("e<1", 1.5, None, "x" * 32767, 2.0), ("e2", None, None, None, None), ("e3", None, None, None, None)], kind).coalesce(1)
    assert files.layout(df.columns) == [
        ("Identifier", ["openms_ceid"], 128), ("Intensities", ["r1_____intensity", "r2_____intensity"], 96), ("Peptide identification", ["r1_____l_pep_ident"], 96),
        ("Feature_First_Isotope_mz_start", ["first_iso_global_min_mz"], None),
    ]
    assert len(files.REPORT) == 23
    names = files.xlsx(df, str(tmp_path / "out"), rows=2)
    sheets = [zipfile.ZipFile(tmp_path / "out" / n).read("xl/worksheets/sheet1.xml").decode() for n in names]
    assert len(sheets) == 2 and '<mergeCell ref="B1:C1"/>' in sheets[0] and "e&lt;1" in sheets[0] and '<col min="1" max="1" width="18.29"' in sheets[0] and "<v>1.5</v>" in sheets[0] and "x" * 32767 in sheets[0]
    assert "e2" in sheets[0] and "e3" in sheets[1] and sorted(os.listdir(tmp_path / "out")) == names
    with pytest.raises(Exception, match="32767 characters"):
        files.xlsx(df.withColumn("r1_____l_pep_ident", F.repeat(F.lit("x"), 40000)), str(tmp_path / "long"))

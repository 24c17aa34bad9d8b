"""Golden values of the column functions."""

import pytest
from pyspark.sql import functions as F

from statuta.functions import dates, eu, prep, refs, text, urls
from statuta.plans.domain import ARTICLES, SENTENCES


def each(spark, values, f):
    rows = spark.createDataFrame(list(enumerate(values)), "n int, s string").select("n", f(F.col("s")).alias("r")).collect()
    return [r.r for r in sorted(rows)]


def test_dates(spark):
    cases = {
        "2024-07-08": "2024-07-08", "2024-07-09 14:55": "2024-07-09", "2024-07-09 14:55:30": "2024-07-09", "02.01.2006": "2006-01-02", "02.01.2006 15:04": "2006-01-02", "01/02/2006": "2006-01-02",
        "2024-07-08T00:00:00Z": "2024-07-08", "Inntektsåret 1998": None, "1965-07-01, 1967-04-23": None, "2051-01-01": None, "2023-02-30": None, "": None, None: None,
    }
    assert each(spark, list(cases), dates.canonical) == list(cases.values())
    assert each(spark, ["Kongen bestemmer", " ", "2001-01-01"], dates.raw_companion) == ["Kongen bestemmer", None, None]


def test_loose_years(spark):
    cases = {"2004-01-01": 2004, "Inntektsåret 1998": 1998, "Kongen bestemmer, 2004-01-01, 2005-01-01": 2004, "Ikkje i kraft": None, "": None, "1814-05-17": 1814, "abc 3000-01-01": None, "3000-01-01": 3000, None: None}
    assert each(spark, list(cases), dates.loose_year) == list(cases.values())
    assert each(spark, ["x"], lambda s: dates.decade(F.lit(1998))) == ["1990s"]


def test_date_defects_and_live_form(spark):
    assert each(spark, ["2020-01-01", "2023-02-30", "2051-01-01", "x"], dates.defect) == [None, "calendar", "year", "format"]
    assert each(spark, ["2024-07-08T00:00:00Z", "2024-07-08"], lambda s: dates.same_day(F.lit("2024-07-08"), s)) == [True, False]


def test_celex(spark):
    cases = {
        "EØS-avtalen vedlegg IX nr. 8 (direktiv 2009/103/EF)": ["32009L0103"], "EØS-avtalen vedlegg II (direktiv 2014/40/EU)": ["32014L0040"], "EØS-avtalen vedlegg XIX nr. 7a (direktiv 93/13/EØF).": ["31993L0013"],
        "EØS-avtalen vedlegg XVII nr. 1 (direktiv 87/54).": ["31987L0054"], "EØS-avtalen protokoll 28 (forordning (EF) nr. 469/2009)": ["32009R0469"], "EØS-avtalen vedlegg XIII forordning (EU) 2019/621.": ["32019R0621"],
        "EØS-avtalen vedlegg XIII nr. 53 (forordning (EØF) nr. 4055/86)": ["31986R4055"], "Europaparlaments- og rådsbeslutning nr. 768/2008/EF": ["32008D0768"], "vedlegg XI nr. 5i (direktiv (EU) 2015/1535)": ["32015L1535"],
        "nr. 1ea (forordning (EF) nr. 1221/2009), nr. 1f (direktiv 2010/75/EU)": ["32009R1221", "32010L0075"], "ingen": [],
    }
    assert each(spark, list(cases), eu.celex_ids) == list(cases.values())
    assert each(spark, ["32003l0004", "2009/103/EF", "93/13", "x"], eu.celex_of) == ["32003L0004", "32009L0103", "31993L0013", None]
    assert each(spark, ["31993L0013", "32009L0103", "32014L0040"], eu.community) == ["EØF", "EF", "EU"]


def test_reference_types(spark):
    want = [
        ("implements", "gjennomfører"), ("implements", "gjennomføring"), ("supplements", "supplerer"), ("supplements", "utfyller"), ("applies", "gjelder direkte"), ("applies", "får direkte anvendelse"),
        ("applies", "anvendes direkte"), ("complies_with", "i samsvar med"), ("complies_with", "oppfyller"), ("complies_with", "etterlever"), ("derogates_from", "fravik"), ("amended_by", "endret ved"),
        ("amended_by", "endring av"), ("repealed_by", "opphevet ved"), ("repealed_by", "oppheving av"), ("references", "viser til"), ("references", "henviser til"), ("references", "refererer til"), ("references", ""),
    ]
    assert [tuple(r) for r in each(spark, SENTENCES, eu.reference_type)] == want


def test_articles(spark):
    want = [["6.1.a"], ["6"], ["6.1.a"], ["6.1.a", "6.1.c"], ["13-15"], ["6", "7", "8"], ["6.1.a", "6.1.c"], [], [], ["6", "6.1.a", "13-15"]]
    assert each(spark, ARTICLES, eu.articles) == want


def test_context(spark):
    t = "Første setning. Loven gjennomfører direktiv 2009/103/EF nr. 5 her; resten. Siste."
    assert each(spark, [t, "uten"], lambda s: eu.clause_around(s, F.lit("direktiv 2009/103"))) == ["Loven gjennomfører direktiv 2009/103/EF nr", None]


def test_amendment_notes(spark):
    cases = {
        "Endret ved lov 14 juni 2024 nr. 20": ("endret", "2024-06-14", "lov/2024-06-14-20"), "Endret ved lov 14. juni 2024 nr. 20": ("endret", "2024-06-14", "lov/2024-06-14-20"),
        "Endra ved lov 22 des 2021 nr. 161": ("endret", "2021-12-22", "lov/2021-12-22-161"), "Opphevet ved lov 15 mai 2009 nr. 28": ("opphevet", "2009-05-15", "lov/2009-05-15-28"),
        "Tilføyd ved lov 20 des 2019 nr. 53": ("tilfoyd", "2019-12-20", "lov/2019-12-20-53"), "Ny lydelse ved lov 20 des 2019 nr. 53": ("ny_lydelse", "2019-12-20", "lov/2019-12-20-53"),
        "Ny ordlyd ved lov 1 jan 2020 nr. 5": ("ny_lydelse", "2020-01-01", "lov/2020-01-01-5"), "Endret ved lov 4 april 2018 nr. 9": ("endret", "2018-04-04", "lov/2018-04-04-9"),
        "Ny lydelse skal lyde:": ("ny_lydelse", "", ""), "En helt vanlig setning uten note.": None, "Lovens § 5 første ledd.": None, "": None,
    }
    assert [r and tuple(r) for r in each(spark, list(cases), prep.note)] == list(cases.values())


def test_preparatory_works(spark):
    cases = {
        "otprp-76-200809": ("proposisjon", "2008-2009", "76", "2008"), "otprp-1-199798": ("proposisjon", "1997-1998", "1", "1997"), "prop-71-ls-202526": ("proposisjon", "2025-2026", "71", "2025"),
        "inns-s-196-199900": ("innstilling", "1999-2000", "196", "1999"), "inns-100-l-201213": ("innstilling", "2012-2013", "100", "2012"), "lovvedtak-10-202223": ("lovvedtak", "2022-2023", "10", "2022"),
        "nou-1997-26": ("nou", "", "26", "1997"), "nou-1991-12a": ("nou", "", "12a", "1991"), "stprp-130-196465": ("proposisjon", "1964-1965", "130", "1964"), "meld-st-29-201112": ("melding", "2011-2012", "29", "2011"),
        "dok21-202021": ("dok", "2020-2021", "", "2020"), "representantforslag-136-202425": ("representantforslag", "2024-2025", "136", "2024"), "lovanm-202425-001": ("lovanm", "2024-2025", "001", "2024"),
        "totally-unparseable": ("unknown", "", "", ""), "prop": ("unknown", "", "", ""),
    }
    assert [tuple(r) for r in each(spark, list(cases), prep.classify)] == list(cases.values())
    assert each(spark, ["", "1998", "1999"], prep.era) == ["unknown", "pre_1999", "1999_plus"]
    assert each(spark, ["/forarbeid/dok21-202021/kap10#x", "lov/1"], prep.slug_of) == ["dok21-202021", None]


def test_source_slugs(spark):
    cases = {
        "Prop. 158 L (2024–2025)": ["prop-158-l-202425"], "Ot.prp. nr. 76 (2008-2009)": ["otprp-76-200809"], "St.meld. nr. 1 (2004-2005)": ["meld-st-1-200405"], "Innst. 33 L (2025–2026)": ["inns-33-l-202526"],
        "NOU 2017:15": ["nou-2017-15"], "Prop. 158 L (2024–2025), jf. Prop. 100 L (2024–2025), Prop. 158 L (2024–2025)": ["prop-100-l-202425", "prop-158-l-202425"],
    }
    assert each(spark, list(cases), prep.source_slugs) == list(cases.values())
    assert each(spark, ["inns-o-80-200405", "inns-100-l-201213", "prop-1-2"], prep.candidates) == [["inno-200405-080"], ["inns-201213-100l", "inns-201213-100"], None]


def test_section_refs(spark):
    cases = {"Se § 22 og § 1-3a": ["22", "1-3a"], "§§ 8, 9": [], "§ 1 – 3": ["1-3"], "ingen": [], "æ§5b": ["5b"]}
    assert each(spark, list(cases), refs.section_refs) == list(cases.values())
    assert each(spark, ["§ 8-10", " §§  1 a ", "5", ""], refs.paragraph_number) == ["8-10", "1 a", "5", ""]


@pytest.mark.parametrize(("gap", "act"), [(0, "forskrift/2001-06-15-599"), (78, "forskrift/2001-06-15-599"), (79, "eier")])
def test_attribution_window(spark, gap, act):
    line = f"jf. forskrift/2001-06-15-599 {'x' * gap} § 4-3 og § 5"
    (got,) = each(spark, [line], lambda s: refs.attributed(s, F.lit("eier")))
    assert [tuple(x) for x in got] == [("4-3", act), ("5", "eier")]


def test_keys_and_labels(spark):
    ref = lambda n, s: each(spark, ["lov/1"], lambda a: refs.paragraph_ref(a, F.lit(n), F.lit(s)))[0]
    assert [ref("§ 1-2", "p-1"), ref("", "p-1"), ref("", "")] == ["lov/1#§1-2", "lov/1#p-1", "lov/1"]
    assert each(spark, ["kapittel-3-ledd-2", "kapittel-1-kapittel-1-ledd-2", "vedlegg-2", "del"], text.section_label) == ["Kapittel 3, ledd 2", "Kapittel 1, ledd 2", "Vedlegg 2", "del"]
    assert each(spark, ["lov/2005 § Å"], text.key_part) == ["lov_2005____"]
    names = ["b 10", "b 9", "a", "10", "9"]
    assert [n for _, n in sorted(zip(each(spark, names, text.natural_key), names, strict=True))] == ["9", "10", "a", "b 9", "b 10"]


def test_text(spark):
    assert each(spark, ["a  b\n c", None], text.squeeze) == ["a b c", None]
    assert each(spark, ["Hei, på § 5-1a!", ""], text.tokens) == [["hei", "på", "5", "1a"], []]
    assert each(spark, ["Jeg FINNER IKKE svar", "Svaret er ja"], text.is_refusal) == [True, False]
    assert each(spark, ["Intro\n1. En\nvidere\na) To\n\nSide 1 av 2\n\n§ 3 Tre"], text.points) == [["Intro", "1. En videre", "a) To", "§ 3 Tre"]]


def test_urls(spark):
    assert each(spark, ["https://WWW.Example.no./a/b%20c.pdf?x#y"], urls.host) == ["www.example.no"]
    assert each(spark, ["https://e.no/a/b%20c.pdf?x#y"], urls.file_name) == ["b c.pdf"]
    assert each(spark, ["eksamen-v26.pdf", "v26b", "av26", "H25"], urls.semester) == ["v26", "", "", "h25"]
    assert each(spark, ["a/b:c", ""], urls.cache_name) == ["a_b_c", "_"]


def test_scores(spark):
    rows = [
        (["lov/1#§1"], ["lov/1#§1"], ["lov/1#§1"], 1.0, 1.0), (["lov/1#§2"], ["lov/1#§1"], ["lov/1#§2"], 0.5, 0.5), (["lov/2#§1"], ["lov/1#§1"], [], 0.0, 0.0),
        ([], ["lov/1#§1"], [], 0.0, 0.0), (["lov/1"], [], ["lov/1"], 0.0, 1.0), (["lov/1#§1", "lov/9#§1"], ["lov/1#§1"], ["lov/1#§1"], 0.5, 1.0),
    ]
    from statuta.operators import evals

    df = spark.createDataFrame([r[:3] for r in rows], "cited array<string>, gold array<string>, resolved array<string>")
    assert [(r.precision, r.recall) for r in evals.scores(df).collect()] == [r[3:] for r in rows]

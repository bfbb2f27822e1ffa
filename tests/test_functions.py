import random

from cadenza.functions import schedule as S
from cadenza.functions import text as T


def model_period(text):
    """Plain model of the short string: try every token count."""
    text = text.lower().strip()
    tokens = (text if text.endswith(";") else text + ";").split(";")[:-1]
    size = next(
        k for k in range(1, len(tokens) + 1)
        if len(tokens) % k == 0 and tokens[:k] * (len(tokens) // k) == tokens
    )
    unit = tokens[:size] * (2 if size == 1 else 1)
    return "".join(t + ";" for t in unit)


def test_cycle_days(values):
    cases = {
        "21-day cycle": (21, "day"),
        "21- to 28-day cycle": (21, "day"),
        "3-week schedule": (21, "week"),
        "14 to 21 days": (None, "14 to 21 days"),
        "28-day cycle for 6 cycles": (28, "day"),
        "6 months": (180, "months"),
        "2 - year plan": (730, "year"),
        "5-fold then 3 days": (None, "5-fold then 3 days"),
        "  Full cycle ": (None, "full cycle"),
        None: (None, "none"),
    }
    got = values(S.cycle_parts, list(cases))
    assert [tuple(r) for r in got] == list(cases.values())


def test_day_list(values):
    got = values(S.day_list, ["1,2", "None", "1-5", "-3 and 10", None, "", "1,99999999999999999999,-99999999999999999999", "0000000000000000000001,3", "9999999999999999999"])
    # A number that no long holds is a day of no cycle; leading zeros don't matter.
    assert got == [[1, 2], None, [1, -5], [-3, 10], None, None, [1], [1, 3], []]


def test_short_string_goldens(values):
    got = values(
        S.short_string,
        ["27.Bendamustine;1.Bendamustine;27.Bendamustine;1.Bendamustine", "7.Docetaxel;7.Docetaxel", "7.A", "a;b;c", ""],
    )
    assert got == [
        "27.bendamustine;1.bendamustine;", "7.docetaxel;7.docetaxel;", "7.a;7.a;", "a;b;c;", ";;",
    ]


def test_short_string_against_model(values):
    rng = random.Random(4)
    texts = []
    for _ in range(400):
        unit = ";".join(f"{rng.choice([0, 1, 11])}.{rng.choice(['A', 'b', 'aé'])}" for _ in range(rng.randint(1, 4)))
        texts.append(";".join([unit] * rng.randint(1, 4)) + rng.choice(["", ";"]))
    short = values(S.short_string, texts)
    assert short == [model_period(t) for t in texts]
    assert values(S.short_string, short) == short
    bare = values(lambda c: S.short_string(c, trailing=False), texts)
    assert bare == [
        s if t.rstrip(";").count(";") == 0 else s[:-1] for s, t in zip(short, texts, strict=True)
    ]


def test_clean_text(values):
    cases = {
        "  (Abc) d-é_1 ": "abc dé_1", None: "", "β-Carotene\u2003": "βcarotene", "a\tb": "a\tb", "\u00a0x\x1f": "x", "- -": "", "5-FU, 10%": "5fu 10",
    }
    assert values(T.clean_text, list(cases)) == list(cases.values())


def test_split_units(values):
    cases = {
        "Aspirin and (Heparin) or B|C": ["aspirin", "heparin", "b", "c"],
        "band or sand": ["band", "sand"],
        "and": [],
        None: None,
        "éor x or  y": ["éor x", "y"],
        "a, b[c]": ["a b c"],
        "A AND b": ["a", "b"],
        "x or or y": ["x", "y"],
    }
    assert values(T.split_units, list(cases)) == list(cases.values())


def test_terms(values):
    assert values(T.blacklist_terms, ["Clarithromycin (Biaxin)", "steroid"]) == [
        ["clarithromycin", "biaxin"], ["steroid"],
    ]
    assert values(T.correct, ["palictaxel", "alfa", "other", None]) == ["paclitaxel", "alpha", "other", None]
    assert values(T.is_number_unit, ["12", "12+", "12++", "a1", ""]) == [True, True, False, False, False]
    assert values(T.drug_key, [" Folinic Acid ", "x", "éA"]) == ["Folinicacid", "X", "Éa"]
    assert values(T.clean_vocabulary, [" A(b),[C] "]) == ["a b   c"]
    assert values(T.compare_key, ["7.A;;", "b"]) == ["7.a", "b"]


def test_title_case(values):
    texts = ["5-fu", " o'neil drug", "abc DEF", "x2y", ""]
    assert values(T.title_case, texts) == [t.strip().title() for t in texts]


def test_new_names(values):
    cases = {
        "Bortezomib, Thalidomide, Dexamethasone, and Panobinostat (TP)": "bortezomib,thalidomide,,panobinostat",
        "Bortezomib, Thalidomide, Dexamethasone and Panobinostat": "bortezomib,thalidomide,panobinostat",
        "Melphalan flufenamide and Dexamethasone": "melphalan flufenamide monotherapy",
        "Tegafur and Uracil, Folinic acid": "tegafur,uracil monotherapy",
        "VMP, then Rd": "vmp + rd",
        "VMP/Rd (KR)": "vmp / rd",
        "A , B": "a,b",
    }
    assert dict(zip(cases, values(T.normalise_new_name, list(cases)), strict=True)) == cases


def test_old_names(values):
    assert values(T.normalise_old_name, ["Carfilzomib", "A & B", "Vmp / RD", " x , y and z"]) == [
        "carfilzomib monotherapy", "a,b", "vmp / rd", "x,y,z",
    ]

import datetime as dt
import re

import pytest

from ledgerline.llm import pseudonyms as P
from tests.llm.data import awkward, frame, with_clash


@pytest.mark.parametrize("size", [1, 2, 3, 10, 37, 100, 1009])
def test_permutation(size):
    to = [P.permute(x, size, b"k", "t") for x in range(size)]
    assert sorted(to) == list(range(size))
    assert [P.permute(y, size, b"k", "t", inverse=True) for y in to] == list(range(size))
    if size > 100:
        assert to != [P.permute(x, size, b"other", "t") for x in range(size)]


VALUES = ["4111111111111111", "4111 1111 1111 1111", "3782-822463-10005", "GB82WEST12345698765432", "DE89 3704 0044 0532 0130 00",
          "078-05-1120", "+1 (017) 555-7713", "(212) 555-1234", "212-555-1234", "+49 30 1234 5678", "+33 1 23 45 67 89", "+14155552671", "97.51.17.173", "2020-02-29", "2/28/2021",
          "25/12/1999", "212 555 1234", "0049 30 1234 5678", "00 354 581 2345", "+44 (0)20 7946 0958", "078 05 1120", "March 4th, 2021",
          "4 March 2021", "04-Mar-2021", "SEPT. 9, 1999", "1st of may 2001", "25.12.1999", "ann.55@mail4.example.com"]
LEFT = ["122 155 1234", "2125551234", "0049301234567", "00 1 23 4567 890", "030 1234567", "3/4/21", "February 30, 2021", "May 4, 1821", "Marching 4, 2021",
        "000 05 1120", "4111111111111112", "999.1.1.1", "127.0.0.1", "2021-02-29", "000-12-1234", "GB82WEST12345698765431", "version 4.0", "31.02.2020",
        "a@b", "1234567890123456789012", "deadbeef4111111111111111", "in 1999 or 2001"]


def shape(s):
    return re.sub("[a-z]", "a", re.sub("[A-Z]", "A", re.sub(r"\d", "9", s)))


@pytest.mark.parametrize("value", VALUES)
def test_value(value):
    new, n = P.pseudonyms(value)
    assert n == 1 and new != value
    if "." not in value or "@" in value or value.startswith("25"):
        assert shape(new) == shape(value) or "/" in value or re.search("mar|may|sept", value, re.I)   # months differ in length
    again, m = P.pseudonyms(new)
    assert m == 1                                            # valid again
    text, k = P.pseudonyms(f"x ({value}), {value}!! {value}### y")
    assert k == 3 and text == f"x ({new}), {new}!! {new}### y"
    assert P.pseudonyms(value, b"another key")[0] != new


@pytest.mark.parametrize("text", LEFT)
def test_left_alone(text):
    assert P.pseudonyms(text) == (text, 0)


def test_formats_stay_valid():
    for i in range(300):
        payload = f"{i * 7919 + 10 ** 14:015d}"
        new, n = P.pseudonyms(payload + P.luhn_digit(payload))
        assert n == 1 and P.luhn_digit(new[:-1]) == new[-1]
        day = dt.date(1900, 1, 1) + dt.timedelta(days=i * 211)
        assert dt.date.fromisoformat(P.pseudonyms(day.isoformat())[0])
        ip = P.pseudonyms(f"{i % 223 + 1}.{i % 256}.7.9")[0]
        assert all(0 <= int(p) < 256 for p in ip.split("."))


def test_one_to_one():
    cards = [p + P.luhn_digit(p) for p in (f"{i:012d}" for i in range(2000))]
    assert len({P.pseudonyms(c)[0] for c in cards if len(set(c)) > 1}) == sum(len(set(c)) > 1 for c in cards)
    days = [(dt.date(2000, 1, 1) + dt.timedelta(days=i)) for i in range(800)]
    for form in ("{0.month}/{0.day}/{0.year}", "{0:%Y-%m-%d}", "{0:%d.%m.%Y}"):
        texts = {form.format(d) for d in days}
        assert len({P.pseudonyms(t)[0] for t in texts}) == len(texts)


def test_time_of_day_stays():
    new, n = P.pseudonyms("at 2021-03-04T10:20:30Z")
    assert n == 1 and new.endswith("T10:20:30Z") and "2021-03-04" not in new


def test_overlapping_candidates():
    """A longer candidate that fails does not hide a valid value inside it."""
    assert P.pseudonyms("AB12 3456 4111 1111 1111 1111")[1] == 1
    assert P.pseudonyms("42 4111111111111111 17")[1] == 1


def test_rows(spark):
    rows = [*awkward(30), (7, "call +1 (017) 555-7713 " + VALUES[0], "en", "s", 999), (None, VALUES[0], "en", "s", None)]
    df = with_clash(frame(spark, rows), "_pseudonyms", "n_values", "_p")
    got = P.query(df).collect()
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(str((r[0], *P.pseudonyms(r[1]))) for r in rows)
    out = P.pseudonymise(df)
    assert out.columns == df.columns
    want = [(i, new, lang, source, len(new) if n else chars) for i, t, lang, source, chars in rows for new, n in [P.pseudonyms(t)]]
    assert sorted(map(str, want)) == sorted(str(tuple(r)[:5]) for r in out.collect())
    assert P.query(frame(spark, [])).count() == 0


def national(text):
    new, n = P.pseudonyms(text)
    assert n == 1
    return re.sub(r"\D", "", new.replace("(0)", ""))


@pytest.mark.parametrize("code,forms", [
    ("1", ["+1 555 123 4567", "+15551234567", "+1 (555) 123-4567", "001 555 123 4567", "1-555-123-4567", "1 (555) 123-4567"]),
    ("49", ["+49 30 12345678", "+493012345678", "+49 (0)30 1234 5678", "0049 30 1234-5678", "00 49 30 12345678"]),
    ("354", ["+354 581 2345", "+3545812345", "00354 581 23 45"])])
def test_notations_of_a_phone_number_stay_linked(code, forms):
    """The country code is kept and no digit of the number is; the inverse permutation gives it back."""
    got = {national(f).removeprefix("00") for f in forms}
    assert len(got) == 1
    new = got.pop()
    own = re.sub(r"\D", "", forms[0])[len(code):]
    assert new.startswith(code) and len(new) == len(code) + len(own) and new[len(code):] != own
    if code != "1":
        back = P.permute(int(new[len(code):]), 10 ** len(own), P.DEMO_KEY, f"phone{code}-{len(own)}", inverse=True)
        assert f"{back:0{len(own)}d}" == own


def test_north_american_numbers_without_code_are_linked():
    for forms in (["+1 212 555 1234", "(212) 555-1234", "212-555-1234", "212.555.1234", "212 555 1234"], ["+1 (017) 555-7713", "017-555-7713"]):
        assert len({national(f)[-10:] for f in forms}) == 1
    numbers = [f"{a}-{b}-{c:04d}" for a in (201, 999, 17 + 100) for b in (200, 155) for c in range(60)]
    assert len({national(x) for x in numbers}) == len(numbers)


def test_phone_before_another_value():
    new, n = P.pseudonyms("call +1 (826) 555-4081 190.137.2.9 now")
    assert n == 2 and re.fullmatch(r"call \+1 \(\d{3}\) \d{3}-\d{4} \d+\.\d+\.\d+\.\d+ now", new)


def test_dates_are_linked_over_notations():
    day = dt.date.fromisoformat(P.pseudonyms("2021-03-04")[0])
    for form, want in (("March 4, 2021", "%B {d}, %Y"), ("4 March 2021", "{d} %B %Y"), ("Mar 4 2021", "%b {d} %Y"), ("4-Mar-2021", "{d}-%b-%Y"),
                       ("04.03.2021", "%d.%m.%Y")):
        assert P.pseudonyms(form) == (day.strftime(want.replace("{d}", str(day.day))), 1)
    for i in range(400):
        d = dt.date(1990, 1, 1) + dt.timedelta(days=i)
        iso = dt.date.fromisoformat(P.pseudonyms(d.isoformat())[0])
        assert P.pseudonyms(f"{d:%B} {d.day}, {d.year}")[0] == f"{iso:%B} {iso.day}, {iso.year}"

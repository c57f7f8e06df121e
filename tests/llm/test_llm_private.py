"""Private values beside other text, of all countries, and inside shapes that are not valid."""

import pytest

from tidemark.llm import pseudonyms

IBANS = [
    "BE68 5390 0754 7034", "AT61 1904 3002 3457 3201", "ES91 2100 0418 4502 0005 1332", "BE68539007547034",
    "GR16 0110 1250 0000 0001 2300 695", "NO93 8601 1117 947", "MT84MALT011000012345MTLCAST001S",
]


def masked(text):
    f = pseudonyms.Feistel(b"key")
    out, spans = pseudonyms.pseudonymise(text, f)
    assert pseudonyms.pseudonymise(out, f, undo=True)[0] == text
    return out, spans


@pytest.mark.parametrize("value", IBANS)
@pytest.mark.parametrize("after", ["", ".", " EUR", " BIC", " BANK", " I", " A1 B2", " 12", " paid"])
def test_ibans_end_where_their_country_says(value, after):
    out, spans = masked(f"to {value}{after}")
    assert [(kind, start, size) for kind, start, size in spans] == [("iban", 3, len(value))]
    assert value not in out and out.endswith(after)


@pytest.mark.parametrize("country", sorted(pseudonyms.IBAN_LENGTHS))
def test_ibans_of_every_country(country):
    account = "".join(str(i * 7 % 10) for i in range(pseudonyms.IBAN_LENGTHS[country] - 4))
    plain = country + pseudonyms.iban_digits(country, account) + account
    spaced = " ".join(plain[i : i + 4] for i in range(0, len(plain), 4))
    for value in (plain, spaced):
        assert [x[0] for x in masked(f"{value} EUR")[1]] == ["iban"]


@pytest.mark.parametrize("value", ["(974) 555 3436", "974 555 3436", "974.555.3436", "(974)555-3436"])
def test_national_phones(value):
    out, spans = masked(f"call {value}, now")
    assert [x[0] for x in spans] == ["phone"] and value not in out


def test_the_search_goes_on_inside_what_is_not_valid():
    out, spans = masked("DE00 4539 1488 0343 6467 1234 56")
    assert [x[0] for x in spans] == ["card"] and out.startswith("DE00 ") and out.endswith(" 1234 56")

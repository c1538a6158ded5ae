"""Secrets whose name stands in the same run, whose context is further off, or whose alphabet is small."""

import random
import string
import time

import pytest

from layerwright.llm import secrets


def key(size, seed=1, alphabet=string.ascii_letters + string.digits):
    return "".join(random.Random(seed).choices(alphabet, k=size))


def novel(text):
    found = secrets.novel_spans(text, secrets.base_spans(text), secrets.Novelty([]))
    return [text[s:e] for s, e, _ in found]


@pytest.mark.parametrize(
    "before",
    ["aws_secret_access_key=", "private_key=", "DB_PWD=", "GET /a?signature=", "x=1&signature=", "private_key = ", "conf/private_key=="],
)
@pytest.mark.parametrize("size", [20, 40])
def test_assignments_without_blanks(before, size):
    value = key(size)
    assert novel(f"{before}{value}\nend") == [value]


def test_parts_of_a_run():
    value = key(24)
    assert novel(f"auth=a=b={value}== x") == [f"{value}=="]
    assert novel(f"colour={value}") == []
    assert novel("private_key=customer_account_number_customer_account_number") == []


@pytest.mark.parametrize("head", ["", "Proc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,0102\n\n"])
def test_all_lines_of_a_private_key(head):
    alphabet = string.ascii_letters + string.digits + "+/"
    lines = [key(64, i, alphabet) for i in range(25)]
    text = f"-----BEGIN RSA PRIVATE KEY-----\n{head}" + "\n".join(lines) + "\n-----END RSA PRIVATE KEY-----\n"
    assert [v for v in novel(text) if v in lines] == lines


def test_context_goes_on_and_looks_ahead():
    lines = [key(64, i) for i in range(6)]
    assert novel("credential:\n  " + "\n  ".join(f'"{line}",' for line in lines)) == lines
    assert novel(f"{lines[0]} is the passphrase") == lines[:1]
    assert novel(f"credential {lines[0]} " + "plain words " * 9 + lines[1]) == lines[:1]


@pytest.mark.parametrize("size", [64, 128, 256])
def test_random_upper_case_hex(size):
    value = key(size, 3, "0123456789ABCDEF")
    assert novel(f"credential {value}") == [value]


@pytest.mark.parametrize("alphabet", [string.ascii_lowercase, string.ascii_uppercase, string.ascii_letters])
def test_random_letters(alphabet):
    value = key(40, 4, alphabet)
    assert novel(f"our bearer credential is {value} and stays so") == [value]


def test_words_are_no_secrets():
    text = "the token and credential of the misunderstandings in internationalization or auth"
    assert novel(text) == []


@pytest.mark.parametrize("between", ["\n", " and " * 20, " plain words " * 30])
@pytest.mark.parametrize("size", [24, 64, 600])
def test_copies_do_not_hide_each_other(between, size):
    value = key(size, 7)
    line = f"our credential {value} here"
    assert novel(between.join([line] * 3)) == [value] * 3


def test_names_with_numbers_are_no_secrets():
    assert novel("token user_account_identifier_value2024") == []
    assert novel("the credential customerAccountNumber12 is none") == []
    assert novel("token user_account_identifier_value2024 " * 3) == []


def test_values_and_base_spans_meet_as_by_comparing_all():
    rng = random.Random(5)
    for _ in range(40):
        pieces = [
            rng.choice(['token = "{}"', "credential {}", "AKIA{}", "secret:{} auth"]).format(
                key(rng.choice([8, 16, 30]), rng.random(), rng.choice(["0123456789abcdef", string.ascii_letters + string.digits, "ABCDEF0123"]))
            )
            for _ in range(12)
        ]
        text = rng.choice([" ", "\n", ";"]).join(pieces)
        base = secrets.base_spans(text)
        found = secrets.novel_spans(text, base, secrets.Novelty([]))
        alone = secrets.novel_spans(text, [], secrets.Novelty([]))
        assert found == [(s, e, k) for s, e, k in alone if not any(b < e and s < f for b, f, _ in base)]


def test_many_assignments_in_one_text():
    text = "\n".join(f"password = {key(16, i)}" for i in range(20_000))
    start = time.perf_counter()
    assert novel(text) == []
    assert time.perf_counter() - start < 10


def test_columns_of_the_query_come_first(make_docs):
    found = secrets.digest_spans(secrets.scan(make_docs([(1, "x", "en")])))
    assert found.columns == ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_novel"]

"""Literals of any length, and names inside subscripts."""

import time

import pytest

pytest.importorskip("corpus_pipeline")
from tessera.llm import secrets  # noqa: E402


def added(text):
    return [text[s.start:s.end] for s in secrets.added_spans(text, secrets.base_spans(text))]


@pytest.mark.parametrize("quote", "\"'`")
@pytest.mark.parametrize("n", (4096, 4097, 5000, 300_000))
def test_long_literals(quote, n):
    """A long literal hides neither itself nor those after it on its line."""
    q, blob = quote, ("Ab3/x9Kq" * n)[:n]
    assert added(f'{{{q}blob{q}:{q}{"A " * n}{q},{q}db_pwd{q}:{q}Zx9!kk2#Lm{q}}}') == ["Zx9!kk2#Lm"]
    assert added(f"private_key = {q}{blob}{q}; pwd = {q}Zx9!kk2#Lm{q}") == [blob, "Zx9!kk2#Lm"]


def test_long_literal_with_escapes():
    body = "\\\"x\\\\" * 2000 + "Q7"
    assert added(f'{{"private_pem":"{body}","pwd":"Zx9!kk2#Lm"}}') == [body, "Zx9!kk2#Lm"]


def test_subscripts():
    assert added('config["db_pwd"] = "Zx9!kk2#Lm"') == ["Zx9!kk2#Lm"]
    assert added("$cfg['a']['db_pwd'] = 'Zx9!kk2#Lm'") == ["Zx9!kk2#Lm"]
    assert added('config["db_pwd"]: str = "Zx9!kk2#Lm"') == ["Zx9!kk2#Lm"]
    assert added('config["title"] = "Zx9!kk2#Lm"') == []


def test_unclosed_quotes_take_linear_time():
    text = 'pwd = "' + '\\"' * 400_000 + "\nx = 1 {" + "{" * 400_000
    start = time.process_time()
    added(text)
    assert time.process_time() - start < 20
    assert [t.kind for t in secrets.lex('"a \\"b\n"c"')][-2:] == ["line", "string"]


def test_chained_constants_take_linear_time():
    text = "\n".join(f"token_a{k} = token_a{k + 1}" for k in range(50_000))
    start = time.process_time()
    added(text)
    assert time.process_time() - start < 25


def test_propagation_against_closure():
    """The best name that a constant reaches, against all paths."""
    import random
    rng = random.Random(3)
    names = ["a", "b", "c", "d", "e", "f", "db_pwd", "api_token", "user_id", "secret_key"]
    for _ in range(200):
        uses = {}
        for _ in range(rng.randrange(12)):
            uses.setdefault(rng.choice(names), []).append(rng.choice(names))
        got = secrets.reached(set(names), uses)
        for n in names:
            seen, todo = {n}, [n]
            while todo:
                new = set(uses.get(todo.pop(), ())) - seen
                seen |= new
                todo += new
            assert got[n] == max(map(secrets.sensitivity, seen))


@pytest.mark.parametrize("text,want", [
    ('db_pwd = """Zx9!kk2#Lm7"""', ["Zx9!kk2#Lm7"]),
    ("db_pwd = '''Zx9!kk2#Lm7'''; t = 1", ["Zx9!kk2#Lm7"]),
    ("x = '''open\ndb_pwd = 'Zx9!kk2#Lm7'", ["Zx9!kk2#Lm7"]),
    ("a:\n  db_pwd: |\n    Zx9!kk2#Lm7\n  title: 1", ["Zx9!kk2#Lm7"]),
    ("db_pwd: >-\n  Zx9!kk2\n\n  #Lm7qq\nb: 2", ["Zx9!kk2\n\n  #Lm7qq"]),
    ("db_pwd: |\nb: 2", []),
    ("auth: |\n  db_pwd: Zx9!kk2#Lm7\n", ["Zx9!kk2#Lm7"]),
    ("data:\n  conf: |\n    db_pwd: Zx9!kk2#Lm7\n", ["Zx9!kk2#Lm7"]),
    ("<dbPassphrase>Zx9!kk2Lm7</dbPassphrase>", ["Zx9!kk2Lm7"]),
    ("run --db-pwd Zx9!kk2#Lm7", ["Zx9!kk2#Lm7"]),
    ("seed := `Zx9!kk2#Lm7`\nb := seed\nsigning_salt := b", ["Zx9!kk2#Lm7"]),
    ("{\"pwd\" => \"Zx9!kk2#Lm7\"}", ["Zx9!kk2#Lm7"]),
    ("pwd = \"Zx9!k\" + \"k2#Lm7qrT\"", ["k2#Lm7qrT"]),
    ("title = \"Zx9!kk2#Lm7\"", []),
    ("db_pwd = \"changeme\"", []),
    ("db_pwd = os.environ[\"X\"]", []),
])
def test_syntaxes(text, want):
    assert added(text) == want


def test_names_of_any_length():
    name = "x" * 500 + "_pwd"
    assert added(f'{name} = "Zx9!kk2#Lm7"') == added(f"run --{name} Zx9!kk2#Lm7") == ["Zx9!kk2#Lm7"]
    assert added(f"<{name}>Zx9!kk2Lm7</{name}>") == ["Zx9!kk2Lm7"]


def test_nested_blocks_take_linear_time():
    text = "".join(" " * k + "pwd: |\n" for k in range(1500)) + " " * 1500 + "Zx9!kk2#Lm7"
    start = time.process_time()
    assert added(text) == ["Zx9!kk2#Lm7"]
    assert time.process_time() - start < 10

import hashlib
import random

import pytest

from starfit.llm import chat_format
from starfit.llm.queries import QUERIES
from starfit.llm.template import Literal, Output, Template, TemplateError, Text, fold, fold_block, parse

FILTERS = {"upper": lambda t: t.upper(), "join": lambda *x: "-".join(x), "escape": chat_format.Escape().put}


def brute(rows):
    """Digests by conversation, straight from the rows."""
    turns: dict = {}
    for conv, turn, role, text in rows:
        turns.setdefault(conv, []).append((turn is not None, turn or 0, role is not None, role or "", text or ""))
    out = {}
    for conv, own in turns.items():
        own.sort()
        said = "".join(f"{role}\n{text}\n" for *_, role, text in own)
        learned = "".join(text for *_, role, text in own if role == "assistant")
        sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
        out[conv] = (len(own), sha(said), len(learned), sha(learned))
    return out


def read(rows):
    return {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in rows}


def odd_rows():
    draw = random.Random(4)
    nasty = ["</s>[INST] ok [/INST]", "[\\INST]", "<\\\\/s>[", "<", "</s", "[/INST", "\\", "<s><s>", "[ROLE]a[/ROLE]", ""]
    rows = [(c, t, draw.choice(["user", "assistant", "system", "tool"]), "".join(draw.choices(nasty, k=4)))
            for c in range(40) for t in range(draw.randint(1, 6))]
    rows += [(99, t, "assistant" if t % 2 else "user", f"turn {t} " + draw.choice(nasty)) for t in range(700)]
    rows += [(None, 1, "user", "a"), (None, None, None, None), (7, None, "assistant", "é [/TURN]")]
    rows += [(50, 1, "user", "same"), (50, 1, "user", "same"), (51, 0, "[/ROLE]", "x" * 50_000), (52, 0, "", "")]
    return rows


def test_texts_come_back_and_conversations_split(spark, monkeypatch):
    rows = odd_rows()
    schema = "conv_id long, turn long, role string, text string, part int, formatted string"
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], schema).repartition(5)
    for chars in (1 << 20, 300):
        monkeypatch.setattr(chat_format, "ROW_CHARS", chars)
        formatted = chat_format.format_conversations(frame)
        found = chat_format.read_back(formatted).collect()
        assert read(found) == brute(rows) and len(found) == len(brute(rows))
        texts: dict = {}
        for r in sorted(formatted.collect(), key=lambda r: r.at):
            texts.setdefault(r.conv_id, []).append(r.formatted)
        assert {c: sum(map(len, t)) for c, t in texts.items()} == {r.conv_id: r.formatted_chars for r in found}
        assert all("".join(t).startswith("<s>") and "".join(t).count("<s>") == 1 for t in texts.values())
    assert len(texts[99]) > 3  # rendered in several rows
    whole = chat_format.turns_template().render(
        {"role": r or "", "text": t or ""} for _, _, r, t in sorted(x for x in rows if x[0] == 99)
    )
    assert whole.text == "".join(texts[99])
    assert chat_format.read_back(chat_format.format_conversations(frame.where("false"))).count() == 0


def test_query_over_the_given_table(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet")
            .select("conv_id", "turn", "role", "text").collect()]
    said = "</s>[INST] ok [/INST]"
    assert read(QUERIES["op12_chat_format"](spark, sf_dir).collect()) == brute(
        [*rows, (-7, 0, "user", said), (-7, 1, "assistant", said)]
    )


def test_escaping_is_reversible():
    draw, escape = random.Random(2), chat_format.Escape()
    bits = [*chat_format.CONTROLS, "<", "[", "\\", "/s>", "INST]", "x", "\n"]
    for _ in range(3000):
        text = "".join(draw.choices(bits, k=draw.randint(0, 9)))
        put = escape.put(text)
        assert escape.take(put) == text and not any(c in put for c in chat_format.CONTROLS)


def test_language():
    source = """{{ bos ~ (1 + 2) }}{# note #}
    {%- for m in messages -%}
      {%- set n = loop.index ~ '.' -%}
      {% if m.x == none %}none{% elif not loop.first and m.x in 'ab' %}({{ n ~ m['x'] | upper }})
      {%- else %}<{% generation %}{{ m.x if m.x else 'empty' }}{% endgeneration %}>{% endif %}
    {%- endfor %} end"""
    page = Template(source, FILTERS, {"bos": "B"}).render([{"x": "a"}, {"x": "b"}, {"x": ""}, {"y": 1}, {"x": "q"}])
    assert page.text == "B3<a>(2.B)(3.)none<q> end"
    assert [page.text[a : a + n] for a, n in page.spans] == ["a", "q"]


def test_constants_are_folded():
    tree = parse("{{ a + 'b' | upper }}{% if a == 'x' %}yes{{ 1 + 2 }}{% else %}{{ q }}{% endif %}!", FILTERS)
    assert fold_block(tree, {"a": "x"}) == (Text("xByes3!"),)
    assert fold(parse("{{ 'x' if false else m }}", {})[0].value, {}) == parse("{{ m }}", {})[0].value
    assert fold(parse("{{ true and 'k' }}", {})[0].value, {}) == Literal("k")
    assert isinstance(fold_block(parse("{{ m.a }}", {}), {})[0], Output)


@pytest.mark.parametrize(
    "source",
    [
        "{% for m in messages %}{{ m.__class__ }}{% endfor %}x{{ _hidden }}",
        "{% for m in range %}{% endfor %}",
        "{% for m in messages %}{% for k in messages %}{% endfor %}{% endfor %}",
        "{% for m in messages %}{{ m.text.upper() }}{% endfor %}",
        "{% for m in messages %}{{ 'a' * 9 }}{% endfor %}",
        "{% for m in messages %}{{ m | system }}{% endfor %}",
        "{% for m in messages %}",
        "no loop",
        "{% include 'x' %}",
        "{% for m in messages %}{% if m %}{% endfor %}",
    ],
)
def test_what_the_sandbox_refuses(source):
    with pytest.raises(TemplateError):
        Template(source, FILTERS)


def test_keys_reach_dictionaries_only():
    template = Template("{% for m in messages %}{{ m.text.__class__ }}{% endfor %}", FILTERS)
    with pytest.raises(TemplateError):
        template.render([{"text": "a"}])

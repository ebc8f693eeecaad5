"""The template language: rendering, folding, the sandbox, and faults."""

import pytest

from ledgerspark.llm import templates
from ledgerspark.llm.templates import BEGIN, END, Generation, Output, TemplateError, Text, compiled, parse


def render(template, **scope):
    return "".join("[" if p is BEGIN else "]" if p is END else p for p in compiled(template)(scope))


@pytest.mark.parametrize(
    "template, want",
    [
        ("plain", "plain"),
        ("", ""),
        ("{{ 'a' ~ 1 ~ true ~ none }}", "a1true"),
        ("{{ 1 + 2 - 4 }} {{ 7 % 4 }} {{ -3 + 1 }} {{ 'a' + 'b' }}", "-1 3 -2 ab"),
        ("{{ 1 < 2 and 'a' < 'b' }} {{ not 1 == 1 }} {{ 'a' in 'bar' }} {{ 'z' not in 'bar' }}", "true false true true"),
        ("{{ 'yes' if false else 'no' }}{{ 'x' if false }}", "no"),
        ("{{ who.name }}{{ who['name'] }}{{ who[key] }}", "AnnAnnAnn"),
        ("{{ unknown }}{{ unknown.key }}{{ unknown is defined }}{{ who is defined }}{{ who is not defined }}", "falsetruefalse"),
        ("{{ ' A b '|trim|upper }}{{ unknown|default('d') }}{{ 'aXa'|replace('a', '')|lower }}{{ who.name|length }}", "A Bdx3"),
        ("{% if who.name == 'Bob' %}1{% elif who.name == 'Ann' %}2{% else %}3{% endif %}", "2"),
        ("{% if unknown %}1{% elif false %}2{% else %}3{% endif %}", "3"),
        ("{% for x in rows %}{{ loop.index }}/{{ loop.index0 }}{{ x }}{% if not loop.last %},{% endif %}{% if loop.first %}!{% endif %}{% endfor %}", "1/0a,!2/1b,3/2c"),
        ("{% for x in none_left %}x{% endfor %}", ""),
        ("{% set a = 'v' %}{{ a }}{% for x in rows %}{% set a = x %}{{ a }}{% endfor %}{{ a }}", "vabcv"),
        ("{% generation %}a{{ who.name }}{% endgeneration %}b", "[aAnn]b"),
        ("a  {%- if true -%}  b  {%- endif %}  c {# remark -#} d", "ab  c  d"),
        (r"{{ 'it\'s \n' }}", "it's \n"),
        ("{{ '{% raw %}' }}", "{% raw %}"),
    ],
)
def test_renders(template, want):
    assert render(template, who={"name": "Ann"}, key="name", rows=["a", "b", "c"], none_left=[]) == want


@pytest.mark.parametrize(
    "template",
    ["{{ a", "{% if a %}", "{% endif %}", "{% for x in a %}{% endif %}", "{{ a b }}", "{{ (a }}", "{{ a|nothing }}", "{{ a|trim(1) }}", "{% what %}", "{{ }}", "{{ a ? b }}", "{% for if in a %}{% endfor %}", "{% set a == 1 %}", "{{ if }}", "{{ 'a' - 1 }}", "{% else %}", "{% generation %}"],
)
def test_faults_of_a_template_show_when_it_is_compiled(template):
    with pytest.raises(TemplateError):
        compiled(template)


@pytest.mark.parametrize("template", ["{{ a - 1 }}", "{{ a < 1 }}", "{{ b }}", "{% for x in a %}{% endfor %}", "{{ 1 % zero }}", "{{ b|length }}"])
def test_faults_of_values_show_when_it_renders(template):
    with pytest.raises(TemplateError):
        render(template, a="text", b=[1], zero=0)


def test_the_sandbox_has_no_way_to_python_objects():
    assert render("{{ a.__class__ }}{{ a['__class__'] }}{{ m.items }}{{ m.get }}{{ a.upper }}", a="x", m={"k": 1}) == ""
    for template in ("{{ a.upper() }}", "{{ open('x') }}", "{{ a.__class__() }}"):
        with pytest.raises(TemplateError):
            compiled(template)
    with pytest.raises(TemplateError):
        compiled("{{ " + "(" * 60 + "1" + ")" * 60 + " }}")
    with pytest.raises(TemplateError):
        compiled("{% if a %}" * 60 + "{% endif %}" * 60)
    long = "{{ '" + "a" * 1000 + "'" + "|replace('a', 'aaaaaaaaaa')" * 3 + " }}"
    with pytest.raises(TemplateError):
        compiled(long)


def test_constants_are_folded():
    fold = templates.Compiler().fold_all
    assert fold(parse("a{{ 'b' ~ 1 + 1 }}{% if 1 < 2 %}c{% else %}{{ x }}{% endif %}d{% if false %}{{ y }}{% endif %}{{ 'e'|upper }}")) == (Text("ab2cdE"),)
    (output,) = fold(parse("{{ x if true else y }}"))
    assert output == Output(templates.Name("x"))
    assert fold(parse("{% generation %}{{ 'a' }}b{% endgeneration %}")) == (Generation((Text("ab"),)),)
    assert fold(parse("{{ true and x }}")) == (Output(templates.Name("x")),)
    assert fold(parse("{{ false and x }}")) == (Text("false"),)


def test_loops_take_rows_one_by_one():
    taken = []

    def rows():
        for i in range(5):
            taken.append(i)
            yield str(i)

    pieces = iter(compiled("{% for x in rows %}{{ x }}{% endfor %}")({"rows": rows()}))
    assert next(pieces) == "0" and taken == [0, 1]
    assert next(pieces) == "1" and taken == [0, 1, 2]

import pytest

from inkfold import DEFAULT, EMPTY, MetadataDefinition, MetaField, based_on


def triples(definition):
    return [(f.name, f.expr, f.type) for f in definition]


def test_empty_has_no_fields():
    assert len(EMPTY) == 0 and triples(EMPTY) == []


def test_fields_keep_order_expression_and_type():
    definition = (
        EMPTY.with_string("s")
        .with_string("t", "upper(x)")
        .with_integer("i")
        .with_long("l", "a + b")
        .with_double("d")
        .with_temporal("tm", "current_timestamp()")
    )
    assert triples(definition) == [
        ("s", "s", "string"),
        ("t", "upper(x)", "string"),
        ("i", "i", "integer"),
        ("l", "a + b", "long"),
        ("d", "d", "double"),
        ("tm", "current_timestamp()", "temporal"),
    ]


def test_derived_definition_leaves_its_base_alone():
    base = EMPTY.with_string("a").with_integer("b", "x + 1")
    assert triples(based_on(base)) == triples(base)
    derived = based_on(base).with_string("new")
    assert [f.name for f in derived] == ["a", "b", "new"]
    assert [f.name for f in base] == ["a", "b"]


def test_naming_a_field_again_replaces_it_in_place():
    base = EMPTY.with_string("a").with_string("b")
    assert triples(base.with_long("a", "n")) == [("a", "n", "long"), ("b", "b", "string")]
    assert triples(base.extend(EMPTY.with_double("b", "y").with_string("c"))) == [
        ("a", "a", "string"),
        ("b", "y", "double"),
        ("c", "c", "string"),
    ]


def test_default_names_the_nine_fields():
    assert [(f.name, f.type) for f in DEFAULT] == [
        ("form", "string"),
        ("noteid", "string"),
        ("unid", "string"),
        ("created", "temporal"),
        ("addedtofile", "temporal"),
        ("lastmodified", "temporal"),
        ("lastmodifiedinfile", "temporal"),
        ("lastaccessed", "temporal"),
        ("size", "integer"),
    ]


@pytest.mark.parametrize(
    "wrong",
    [
        lambda: based_on(None),
        lambda: EMPTY.extend(None),
        lambda: EMPTY.with_string(None),
        lambda: EMPTY.with_string("", "x"),
        lambda: EMPTY.with_integer("n", ""),
        lambda: EMPTY.with_long("n", None),
        lambda: MetaField("n", "n", None),
        lambda: MetaField("n", "n", "date"),
        lambda: EMPTY.with_string("Name").with_string("name"),
        lambda: MetadataDefinition((MetaField("a", "a", "long"), MetaField("a", "b", "long"))),
    ],
)
def test_bad_arguments_are_refused(wrong):
    with pytest.raises(ValueError):
        wrong()

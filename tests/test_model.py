import pytest

from cdmloom.model.cdm import CDM, spec_frame, struct_type
from cdmloom.model.spec import BY_CONCEPT, BY_MAP, BY_RELATIONSHIP, Lookup, table_spec
from cdmloom.model.vocabulary import VOCABULARY_TABLES
from cdmloom.plans import tables


def test_target_model_shape():
    columns = [c for t in CDM.values() for c in t]
    assert len(CDM) == 20
    assert len(columns) == 279
    assert sum(c.required for c in columns) == 93
    concepts = [c for c in columns if c.name.endswith("_concept_id")]
    assert len(concepts) == 75
    assert sum(1 for c in concepts if c.domain) == 46
    assert sum(1 for c in columns if c.fk and not c.fk.startswith("concept.")) == 49
    for table in CDM.values():
        assert sum(c.pk for c in table) == 1
        assert len({c.name for c in table}) == len(table)


def test_schema_metadata(spark):
    field = struct_type("person")["gender_concept_id"]
    assert not field.nullable
    assert field.metadata == {"fk": "concept.concept_id", "domain": "Gender"}
    assert spec_frame(spark).filter("pk").count() == 20


def test_vocabulary_layouts():
    assert len(VOCABULARY_TABLES) == 10
    assert VOCABULARY_TABLES["drug_strength"]["amount_value"].dataType.simpleString() == "double"


@pytest.mark.parametrize(
    "given",
    [
        {"resolution": BY_MAP},
        {"resolution": BY_CONCEPT, "vocabulary_id": "V"},
        {"resolution": BY_RELATIONSHIP, "domain_id": "D"},
        {"resolution": "guess", "vocabulary_id": "V", "domain_id": "D"},
    ],
)
def test_lookup_needs_its_parameters(given):
    with pytest.raises(ValueError):
        Lookup("a", "c", "t", **given)


CONFIG = {
    "table_name": "person",
    "target_schema": "core",
    "description": "persons",
    "sources": [{"alias": "pat", "table": "{bronze}.patient"}],
    "vocabulary_lookups": [
        {
            "source_alias": "pat",
            "source_column": "race_code",
            "target_column": "race_concept_id",
            "source_vocabulary_id": "Race",
        }
    ],
    "column_mappings": [{"target": "person_id", "expr": "pat.patient_id"}],
    "expectations": {"fail": [{"name": "pk", "expr": "person_id IS NOT NULL"}]},
}


def test_spec_from_plain_data():
    spec = table_spec(CONFIG)
    assert spec.vocabulary_lookups[0].resolution == BY_MAP
    assert spec.vocabulary_lookups[0].fallback == 0
    assert spec.expectations.fail[0].name == "pk"


@pytest.mark.parametrize(
    "change",
    [
        {"colour": "red"},
        {"sources": [{"alias": "pat", "table": "t", "format": "csv"}]},
        {"sources": [{"alias": "other", "table": "t"}]},
        {"column_mappings": [{"target": "x", "expr": "1"}, {"target": "x", "expr": "2"}]},
        {"joins": [{"left": "pat", "right": "nobody", "condition": "true"}]},
    ],
)
def test_spec_rejects(change):
    with pytest.raises(ValueError):
        table_spec(CONFIG | change)


def test_complete_recipes_fill_the_model():
    for name, recipe in tables.RECIPES.items():
        spec = recipe(tables.Style(complete=True))
        targets = [c.target for c in spec.column_mappings]
        assert sorted(targets) == sorted(c.name for c in CDM[name])

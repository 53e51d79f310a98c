"""Layout contract: column counts, names, aliases and declared types."""

import pytest

from ballotbox import schemas

WIDTHS = {"indiv": 21, "cn": 15, "cm": 15, "ccl": 7, "oth": 21, "pas2": 22, "oppexp": 25,
          "weball": 30, "indexp": 36}


@pytest.mark.parametrize("ft,n", sorted(WIDTHS.items()))
def test_width(ft, n):
    assert schemas.width(ft) == n
    assert len(schemas.raw_schema(ft).fields) == n


@pytest.mark.parametrize("ft", schemas.FILE_TYPES)
def test_names_unique_and_aliases_present(ft):
    names = schemas.column_names(ft)
    assert len(set(names)) == len(names)
    assert all(c.alias for c in schemas.columns(ft))
    assert all(c.declared in ("string", "int16", "int64", "float64") for c in schemas.columns(ft))


def test_raw_schema_is_all_strings_with_alias_metadata():
    sch = schemas.raw_schema("indiv")
    assert {f.dataType.simpleString() for f in sch.fields} == {"string"}
    amt = sch["transaction_amt"]
    assert amt.metadata == {"alias": "transaction_amount", "declared_type": "float64"}


def test_declared_types():
    sch = schemas.declared_schema("cn")
    assert sch["cand_election_yr"].dataType.simpleString() == "smallint"
    assert schemas.declared_schema("indiv")["sub_id"].dataType.simpleString() == "bigint"


def test_indiv_inner_file_and_unknown_type():
    assert schemas.INDIV_INNER_FILE == "itcont.txt"
    with pytest.raises(ValueError):
        schemas.columns("nope")

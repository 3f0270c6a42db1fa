import pytest

from barsieve.functions.declared import column_specs, key_columns, key_names, mandatory_columns
from barsieve.plans.views import metadata_frame

# declared type -> (type check, length check, max length, precision, scale)
DECLARED = {
    "DATE": ("date", "unsupported", None, None, None),
    " date ": ("date", "unsupported", None, None, None),
    "DATETIME": ("unsupported", "unsupported", None, None, None),
    "TIMESTAMP": ("unsupported", "unsupported", None, None, None),
    "VARCHAR(10)": ("string", "string", 10, None, None),
    "varchar2( 7 )": ("string", "string", 7, None, None),
    "CHAR(3)": ("string", "string", 3, None, None),
    "STRING(5)": ("string", "string", 5, None, None),
    "VARCHAR": ("string", "string", None, None, None),
    "BIGINT": ("integer", "bigint", 19, None, None),
    "INT": ("integer", "int", 10, None, None),
    "INTEGER": ("integer", "int", 10, None, None),
    "INT(10)": ("integer", "unsupported", None, None, None),
    "SMALLINT": ("integer", "unsupported", None, None, None),
    "TINYINT": ("integer", "tinyint", 3, None, None),
    "DECIMAL(10,2)": ("decimal", "decimal", None, 10, 2),
    "NUMBER(10, 4)": ("decimal", "decimal", None, 10, 4),
    "NUMBER(10)": ("decimal", "decimal", None, 10, 0),
    "FLOAT": ("decimal", "decimal", None, None, None),
    "DOUBLE": ("decimal", "decimal", None, None, None),
    "DECIMAL": ("decimal", "decimal", None, None, None),
    "BOOLEAN": ("unsupported", "unsupported", None, None, None),
}


def test_declared_types(spark):
    names = [f"c{i}" for i in range(len(DECLARED))]
    metadata = metadata_frame(spark, [(n, t, None, False, False) for n, t in zip(names, DECLARED)])
    specs = column_specs(metadata, names)
    got = {
        s.declared: (s.type_check, s.length_check, s.max_length, s.precision, s.scale) for s in specs
    }
    assert got == DECLARED


def test_date_formats_are_unquoted(spark):
    formats = {
        "'MM-YYYY-DD'": "MM-yyyy-dd",
        '"YYYY-MM-DD"': "yyyy-MM-dd",
        "YY/MM/DD": "yy/MM/dd",
        " 'DD/MM/YYYY' ": "dd/MM/yyyy",
        "'DD-MON-YY HH:MI:SS'": "dd-MMM-yy HH:mm:ss",
        "'DD-MON-YYYY'": "dd-MMM-yyyy",
        "'__import__(1)'": None,
        None: None,
    }
    names = [f"c{i}" for i in range(len(formats))]
    metadata = metadata_frame(spark, [(n, "DATE", f, False, False) for n, f in zip(names, formats)])
    assert [s.date_pattern for s in column_specs(metadata, names)] == list(formats.values())


def test_keys_and_mandatory(spark):
    metadata = metadata_frame(spark, [("a", "INT", None, True, False), ("b", "INT", None, False, True)])
    assert [r[0] for r in key_columns(metadata).collect()] == ["a"]
    assert [r[0] for r in mandatory_columns(metadata).collect()] == ["b"]
    a, b = column_specs(metadata, ["a", "b"])
    assert (a.is_key, a.mandatory, b.is_key, b.mandatory) == (True, False, False, True)


def test_missing_or_repeated_metadata_is_an_error(spark):
    metadata = metadata_frame(spark, [("a", "INT", None, True, False), ("b", "INT", None, False, True)])
    with pytest.raises(ValueError, match="c"):
        column_specs(metadata, ["a", "c"])
    with pytest.raises(ValueError, match="a"):
        column_specs(metadata.unionByName(metadata), ["a"])


def test_key_that_is_not_in_the_data_is_an_error(spark):
    metadata = metadata_frame(spark, [("a", "INT", None, True, False), ("b", "INT", None, False, True)])
    assert [s.name for s in column_specs(metadata, ["a"])] == ["a"]
    with pytest.raises(ValueError, match="key columns .* a"):
        column_specs(metadata, ["b"])


def test_keys_keep_the_order_of_the_metadata(spark):
    metadata = metadata_frame(spark, [(c, "INT", None, c != "b", False) for c in "cba"])
    specs = column_specs(metadata, ["a", "b", "c"])
    assert [s.name for s in specs] == ["a", "b", "c"]
    assert key_names(specs) == ["c", "a"]
    turned = column_specs(metadata.orderBy("column_name"), ["a", "b", "c"])
    assert key_names(turned) == ["c", "a"]


def test_keys_are_ordered_by_number(spark):
    metadata = metadata_frame(spark, [(f"c{i}", "INT", None, True, False) for i in range(12)])
    names = [f"c{i}" for i in reversed(range(12))]
    assert key_names(column_specs(metadata.repartition(5), names)) == names[::-1]

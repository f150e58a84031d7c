import os
import tempfile

from strata.schemas import CLAIMS
from strata.sources import files as FS
from strata.sources.tables import read_optional


def test_zero_matching_files_gives_empty_tables(spark):
    d = tempfile.mkdtemp(prefix="strata-empty-")
    with open(os.path.join(d, "notes.md"), "w") as f:
        f.write("not a text document")
    assert FS.scan_text(spark, d, "*.txt").count() == 0
    assert FS.scan_binary(spark, d, "*.docx").count() == 0


def test_absent_optional_table_is_typed_empty(spark):
    df = read_optional(spark, os.path.join(tempfile.mkdtemp(), "create_final_covariates"), CLAIMS)
    assert df.count() == 0 and df.schema == CLAIMS

from pathlib import Path

import pytest

from tests.check_queries import compare, duck
from workload import layers

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="test tables not present")


def test_density_documents_are_bounded(spark, monkeypatch, tmp_path):
    bases = iter(range(1000))
    monkeypatch.setattr(layers, "DOCUMENT_ROWS", 50)
    monkeypatch.setattr(layers, "staging_path", lambda _, label: f"{tmp_path}/{label}-{next(bases)}")
    assert compare(spark, duck(SF), "ingest_density", SF) == ""
    rows = [f.read_text().count("Nom_Barri") for f in tmp_path.glob("drop-*/raw/*/*.txt")]
    areas = len(list(tmp_path.glob("drop-*/raw/*/")))
    assert len(rows) > 2 * areas
    assert max(rows) < 2 * 50

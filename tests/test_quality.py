import pytest

from tidewater.operators.quality import QualityError, quality_gate, quality_report


def _df(spark, n0, n1, nfeat=10, nulls=0):
    cols = [f"f{i}" for i in range(nfeat)]
    rows = []
    for lab, n in ((0, n0), (1, n1)):
        rows += [tuple([float(i)] * nfeat + [lab]) for i in range(n)]
    for i in range(nulls):
        rows[i] = tuple([None] + list(rows[i][1:]))
    return spark.createDataFrame(rows, ", ".join(f"{c} double" for c in cols) + ", target int")


def test_thresholds(spark):
    r = quality_report(_df(spark, 70, 30)).first()
    assert r.total_records == 100 and r.is_valid
    r = quality_report(_df(spark, 70, 29)).first()
    assert r.min_records is False and r.balanced_target is False and not r.is_valid
    r = quality_report(_df(spark, 100, 0)).first()          # single class passes
    assert r.balanced_target and r.min_class_count == 100
    r = quality_report(_df(spark, 80, 30, nfeat=9)).first()
    assert r.min_features is False
    r = quality_report(_df(spark, 80, 30, nulls=3)).first()
    assert r.missing_cells == 3 and r.no_missing is False


def test_empty_fails(spark):
    r = quality_report(_df(spark, 0, 0)).first()
    assert r.total_records == 0 and r.balanced_target is False and r.is_valid is False


def test_gate_raises(spark):
    with pytest.raises(QualityError) as e:
        quality_gate(_df(spark, 10, 10))
    assert '"is_valid":false' in str(e.value)
    assert quality_gate(_df(spark, 70, 30))["is_valid"]

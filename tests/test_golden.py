"""Golden values from the reference's stored notebook output (105 injuries):
counts by BodyPart x Severity and Surface x Severity.  The rows below are
re-entered from those two tables (DM flags are cumulative, so severity s sets
the first s flags)."""

from playtrack.operators import features as FE
from playtrack.operators import reports as R

BODY = {  # BodyPart -> counts for severity 1..4
    "Ankle": [16, 13, 2, 11], "Foot": [0, 0, 2, 5], "Heel": [0, 1, 0, 0], "Knee": [11, 21, 3, 13], "Toes": [2, 4, 1, 0]}
SURFACE = {"Natural": [13, 20, 2, 13], "Synthetic": [16, 19, 6, 16]}


def _rows():
    rows = []
    for sev in range(1, 5):
        parts = [b for b, c in BODY.items() for _ in range(c[sev - 1])]
        surfaces = [s for s, c in SURFACE.items() for _ in range(c[sev - 1])]
        assert len(parts) == len(surfaces)
        flags = [1 if i < sev else 0 for i in range(4)]
        rows += [("p", "g", None, b, s, *flags) for b, s in zip(parts, surfaces)]
    return rows


def test_golden_tables(spark):
    inj = spark.createDataFrame(_rows(), "PlayerKey string, GameID string, PlayKey string, BodyPart string, "
                                          "Surface string, DM_M1 int, DM_M7 int, DM_M28 int, DM_M42 int")
    assert inj.count() == 105
    sev = FE.with_severity(inj)
    body = {(r.BodyPart, r.Severity): r["count"] for r in R.count_by(sev, "BodyPart", "Severity").collect()}
    want = {(b, s + 1): c for b, cs in BODY.items() for s, c in enumerate(cs) if c}
    assert body == want
    surf = {(r.Surface, r.Severity): r["count"] for r in R.count_by(sev, "Surface", "Severity").collect()}
    assert surf == {(b, s + 1): c for b, cs in SURFACE.items() for s, c in enumerate(cs) if c}
    levels = {r.SevLevel: r["count"] for r in R.count_by(sev, "SevLevel").collect()}
    assert levels == {"L": 29 + 39, "H": 8 + 29}

import random

import pytest
from conftest import claim, frame

from claimlens import schemas
from claimlens.operators import governance, kept_keys


def full(tables):
    want = {r.constraint_name: (r.row_count, r.null_keys, r.duplicate_keys, 0, 0) for r in governance.check_primary_keys(tables).collect()}
    return want | {r.constraint_name: (0, 0, 0, r.orphan_rows, r.orphan_keys) for r in governance.check_foreign_keys(tables).collect()}


def so_far(spark, folder):
    return {r[0]: tuple(r[1:]) for r in kept_keys.violations_so_far(spark, folder).collect()}


def records(rng):
    ids = [None, *range(1, 9)]
    name = lambda kind, k: None if k is None else f"{kind}{k}"
    return {
        "members": [{"member_id": name("M", rng.choice(ids))} for _ in range(8)],
        "providers": [{"provider_id": name("P", rng.choice(ids))} for _ in range(6)],
        "claims": [claim(rng.randint(1, 9), member_id=name("M", rng.choice(ids)), provider_id=name("P", rng.choice(ids))) for _ in range(14)],
        "disposition_events": [{"event_id": f"E{rng.randint(1, 9)}", "claim_id": f"C{rng.randint(1, 12)}"} for _ in range(12)],
        "prior_authorizations": [{"pa_id": f"A{k % 4}", "member_id": "M3", "provider_id": "P20"} for k in range(5)],
    }


@pytest.mark.parametrize("seed", [1, 2])
def test_any_split_gives_the_full_check(spark, tmp_path, seed):
    rng = random.Random(seed)
    made = records(rng)
    want = full({t: frame(spark, t, made[t]) for t in made})
    parts = [{t: [] for t in made} for _ in range(3)]
    for t, found in made.items():
        for r in found:
            rng.choice(parts)[t].append(r)
    folder = str(tmp_path / "kept")
    for k, part in enumerate(parts):
        kept_keys.check_batch(spark, folder, f"load{k}", {t: frame(spark, t, part[t]) for t in part if part[t]})
    assert so_far(spark, folder) == want
    assert {k.name for k in schemas.PRIMARY_KEYS + schemas.FOREIGN_KEYS} == set(want)
    # a load that comes again changes nothing
    kept_keys.check_batch(spark, folder, "load1", {t: frame(spark, t, made[t]) for t in made})
    assert so_far(spark, folder) == want and kept_keys.loads(spark, folder) == {"load0", "load1", "load2"}


def test_a_late_parent_takes_orphans_back_and_a_failed_load_does_not_count(spark, tmp_path):
    folder = str(tmp_path / "kept")
    claims = frame(spark, "claims", [claim(1, member_id="M1"), claim(2, member_id="M1"), claim(3, member_id=None)])
    first = {r[0]: tuple(r[1:]) for r in kept_keys.check_batch(spark, folder, "a", {"claims": claims}).collect()}
    assert first["claims_member_fk"] == (0, 0, 0, 3, 2) and first["claims_pk"] == (3, 0, 0, 0, 0)
    # keys of a load without a log entry, as one that failed leaves them
    lost = spark.createDataFrame([("members.member_id", "M1", 1, b) for b in range(64)], "side string, key string, n long, bucket int")
    lost.write.partitionBy("bucket").parquet(f"{folder}/keys/load=lost")
    members = frame(spark, "members", [{"member_id": "M1"}])
    change = {r[0]: tuple(r[1:]) for r in kept_keys.check_batch(spark, folder, "b", {"members": members}).collect()}
    assert change["claims_member_fk"] == (0, 0, 0, -2, -1) and change["members_pk"] == (1, 0, 0, 0, 0)
    with pytest.raises(ValueError):
        kept_keys.check_batch(spark, folder, "c", {"eligibility": claims})

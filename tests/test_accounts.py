import pytest

from faceoff.plans import accounts as U

REQ = "Username string, Password string, UserType string, Timezone string"


def test_account_lifecycle(spark, db):
    name = f"{db}.users"
    U.register(spark, name, spark.createDataFrame([(" Bob\t", "pw", "Admin", "EST"), ("ann", "x", "basic", "pst")], REQ))
    U.register(spark, name, spark.createDataFrame([("BOB", "other", "basic", "cst")], REQ))  # taken
    got = sorted(tuple(r) for r in U.list_users(spark, name).collect())
    assert got == [("ann", "basic", "pst"), ("bob", "admin", "est")]
    U.set_timezone(spark, name, spark.createDataFrame([("bob", "MST"), ("ghost", "pst")], "Username string, Timezone string"))
    assert [tuple(r) for r in U.settings(spark, name, " B o b").collect()] == [("admin", "mst")]
    assert U.user_zone(spark, name, "Bob") == "mst" and U.user_zone(spark, name, "nobody") == "est"
    U.remove(spark, name, spark.createDataFrame([("ANN",)], "Username string"))
    assert [r.Username for r in U.list_users(spark, name).collect()] == ["bob"]


def test_of_repeated_names_the_first_counts(spark, db):
    name, schema = f"{db}.users", REQ + ", asked int"
    rows = [("Bob", "1", "basic", "est", 2), ("b ob", "2", "admin", "pst", 1), ("cy", "3", "basic", "cst", 3)]
    refused = U.register(spark, name, spark.createDataFrame(rows, schema), order_by="asked")
    assert [tuple(r) for r in refused.collect()] == [("bob", "basic", "est", "repeated")]
    again = U.register(spark, name, spark.createDataFrame([("BOB", "x", "basic", "mst"), ("dee", "x", "basic", "mst")], REQ))
    assert [(r["Username"], r["reason"]) for r in again.collect()] == [("bob", "taken")]
    got = sorted(tuple(r) for r in U.list_users(spark, name).collect())
    assert got == [("bob", "admin", "pst"), ("cy", "basic", "cst"), ("dee", "basic", "mst")]


def test_no_requests(spark, db):
    assert U.register(spark, f"{db}.users", spark.createDataFrame([], REQ)).collect() == []
    assert U.list_users(spark, f"{db}.users").collect() == []


@pytest.mark.parametrize(
    "row",
    [("carl", "a,b", "basic", "est"), ("carl", "pw", "root", "est"), ("carl", "pw", "basic", "utc"), ("  ", "pw", "basic", "est")],
)
def test_bad_requests_fail(spark, db, row):
    with pytest.raises(Exception):
        U.register(spark, f"{db}.users", spark.createDataFrame([row], REQ))


def test_one_bad_request_among_many_is_refused(spark, db):
    name = f"{db}.users"
    rows = [("carl", "a,b", "basic", "est"), ("carl", "pw", "basic", "est"), ("dee", "pw", "root", "est"), ("eve", "pw", "Admin", "utc"),
            ("  ", "pw", "basic", "est"), (None, "pw", "basic", "est"), ("F ay", None, " BASIC ", "Mst"), ("gus", "pw", None, "est")]
    refused = U.register(spark, name, spark.createDataFrame(rows, REQ), on_invalid="refuse")
    assert sorted((r["Username"] or "", r["reason"]) for r in refused.collect()) == [
        ("", "empty username"), ("  ", "empty username"), ("carl", "separator in password"), ("dee", "unknown user type"),
        ("eve", "unknown zone"), ("gus", "unknown user type")]
    assert sorted(tuple(r) for r in U.list_users(spark, name).collect()) == [("carl", "basic", "est"), ("fay", "basic", "mst")]
    with pytest.raises(ValueError):
        U.register(spark, name, spark.createDataFrame(rows, REQ), on_invalid="ignore")

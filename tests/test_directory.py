import pytest

from tillmark.fixed_values import REJECT_MISMATCH, REJECT_MISSING, REJECT_TAKEN
from tillmark.operators import directory, quality
from tillmark.plans import charts

USERS = "id long, username string, password string, nickname string, role string"


@pytest.fixture
def users(frame):
    rows = [(i, f"User{i:02d}", "secret", "n", "user") for i in range(1, 46)]
    return frame(USERS, rows + [(100, "root", "secret", "n", "admin")])


def test_paging(users):
    last = directory.user_search_page(users, page=3).collect()
    assert [r.id for r in last] == [5, 4, 3, 2, 1]
    assert {(r.total, r.pages) for r in last} == {(45, 3)}
    assert "password" not in last[0].asDict()
    after = directory.user_search_after(users, last_id=6).collect()
    assert [r.id for r in after] == [5, 4, 3, 2, 1]
    assert [r.id for r in directory.user_search_after(users, None, limit=2).collect()] == [45, 44]


def test_search_is_trimmed_case_insensitive_and_blank_means_all(users):
    assert directory.find_users(users, username="  ").count() == 45
    assert directory.find_users(users, username=" uSER1 ").count() == 10
    assert directory.find_users(users, username="User_1").count() == 5 - 1 + 1
    assert directory.find_users(users, username="User_1", literal=True).count() == 0
    assert directory.find_users(users, role="admin").count() == 1


def test_lookup(users):
    assert directory.user_by_id(users, 7).first().username == "User07"
    assert directory.user_by_name(users, "root").first().id == 100
    assert directory.user_by_name(users, "ROOT").count() == 0


def test_page_payload_past_the_end_keeps_the_total(users):
    found = charts.user_list(users, page=9)
    assert (found["data"], found["total"], found["pages"]) == ([], 45, 3)
    assert len(charts.user_list(users, page=1)["data"]) == 20


BATCH = "id long, username string, nickname string"


def test_conflicts_and_inserts(frame, users):
    batch = frame(BATCH, [(200, "User01", "x"), (202, "new", "late"), (201, "new", "first"),
                          (203, "fresh", "y")])
    found = {r.username: (r.in_batch, r.is_taken)
             for r in directory.name_conflicts(users, batch).collect()}
    assert found == {"User01": (1, True), "new": (2, False)}
    out = directory.apply_inserts(users, batch, role="admin")
    added = {(r.id, r.username, r.role) for r in out.where("id >= 200").collect()}
    assert added == {(201, "new", "admin"), (203, "fresh", "admin")}
    assert directory.apply_inserts(users, batch, check_names=False).count() == 46 + 4


def test_registration(frame, users):
    asked = frame("username string, password string, confirm_password string", [
        ("a", "p", "p"), ("a", "", ""), (None, "p", "p"), ("User01", "p", "q"), ("User01", "p", "p"),
    ])
    out = [r.reject_reason for r in directory.registration_check(users, asked).collect()]
    assert sorted(out, key=str) == sorted(
        [None, REJECT_MISSING, REJECT_MISSING, REJECT_MISMATCH, REJECT_TAKEN], key=str
    )


def test_updates_write_nulls_and_ignore_the_password(frame, users):
    changes = frame("id long, nickname string, password string", [(1, "X", "p"), (2, None, "p")])
    out = {r.id: r for r in directory.apply_updates(users, changes).collect()}
    assert (out[1].nickname, out[2].nickname, out[3].nickname) == ("X", None, "n")
    assert {r.password for r in out.values()} == {"secret"}
    assert directory.apply_deletes(users, changes).count() == 44


@pytest.fixture
def shop(frame, users):
    return {
        "py_user": users,
        "store": frame("id long", [(1,), (2,)]),
        "user_address": frame("id long, user_id long", [(1, 1), (2, 2)]),
        "user_behavior": frame("id long, user_id long, product_id long", [(1, 1, 1), (2, 2, 1)]),
        "product": frame("id long, category_id long, supplier_id long", [(1, 1, 1), (2, 1, 1)]),
        "sales_order": frame("id long, user_id long, store_id long, address_id long",
                             [(1, 1, 1, 1), (2, 2, 1, 2), (3, 2, 2, 1)]),
        "sales_detail": frame("id long, order_id long, product_id long",
                              [(1, 1, 1), (2, 2, 1), (3, 3, 2)]),
    }


def ids(df):
    return sorted(r.id for r in df.collect())


def test_deleting_a_user_takes_orders_and_lines_along(frame, shop):
    out = directory.cascade_delete(shop, "py_user", frame("id long", [(1,)]))
    assert ids(out["user_address"]) == [2] and ids(out["user_behavior"]) == [2]
    assert ids(out["sales_order"]) == [2, 3] and ids(out["sales_detail"]) == [2, 3]
    # Order 3 was shipped to an address of the deleted user.
    assert {r.id: r.address_id for r in out["sales_order"].collect()} == {2: 2, 3: None}
    assert out["product"] is shop["product"]


def test_deleting_a_store_blanks_the_reference(frame, shop):
    out = directory.cascade_delete(shop, "store", frame("id long", [(1,)]))
    assert {r.id: r.store_id for r in out["sales_order"].collect()} == {1: None, 2: None, 3: 2}
    assert ids(out["sales_detail"]) == [1, 2, 3]


def test_deleting_a_product(frame, shop):
    out = directory.cascade_delete(shop, "product", frame("id long", [(1,)]))
    assert ids(out["sales_detail"]) == [3]
    assert {r.product_id for r in out["user_behavior"].collect()} == {None}


def test_quality(frame):
    child = frame("id long, p long", [(1, 1), (2, 9), (3, None)])
    assert ids(quality.orphans(child, frame("id long", [(1,)]), "p")) == [2]
    twice = quality.duplicates(frame("a int, b int", [(1, 1), (1, 1), (1, 2)]), ["a", "b"])
    assert [tuple(r) for r in twice.collect()] == [(1, 1, 2)]
    missing = quality.null_violations(child, ["id", "p"]).collect()
    assert [tuple(r) for r in missing] == [("p", 1)]


def test_change_sets_keep_every_row(frame):
    users = frame("id long, username string, nickname string, role string",
                  [(1, "Alice", "a", "user"), (2, "bob", "b", "user"), (3, None, "c", "user")])
    batch = frame("id long, username string, nickname string",
                  [(10, None, "x"), (11, None, "y"), (12, "alice", "z"), (13, "Bob", "z"), (14, "BOB", "w"), (15, "eve", "v"), (16, "Eve", "u")])
    added = {r.id for r in directory.apply_inserts(users, batch).collect()} - {1, 2, 3}
    assert added == {10, 11, 12, 13, 14, 15, 16}
    added = {r.id for r in directory.apply_inserts(users, batch, ignore_case=True).collect()} - {1, 2, 3}
    assert added == {10, 11, 15}
    found = {r.username for r in directory.name_conflicts(users, batch, ignore_case=True).collect()}
    assert found == {"alice", "bob", "eve"}
    changes = frame("id long, nickname string, at int", [(1, "old", 1), (1, "new", 2), (2, "one", 1), (2, "two", 1), (None, "n", 1)])
    got = {r.id: r.nickname for r in directory.apply_updates(users, changes, "at").collect()}
    assert got == {1: "new", 2: "two", 3: "c"}
    assert directory.apply_updates(users, changes).count() == 3


def test_pages_are_cut_by_id(frame):
    users = frame("id long, username string, role string", [(i * 700, f"u{i}", "user") for i in range(95)])
    want = sorted((i * 700 for i in range(95)), reverse=True)
    for page in (1, 2, 5, 10, 11):
        got = [r.id for r in directory.user_search_page(users, page=page, limit=10).collect()]
        assert got == want[(page - 1) * 10 : page * 10]

"""Uses of data models and what their fields refer to, read off files by hand."""

from corvid.sources import model_usage as M

USES = '''
def handler(session, user: "Optional[app.models.User]", other: Thing, plain: int):
    user.name = "x"
    print(user.name, other)
    order = Order(user=user, item=Item())
    order.save()
    order = lookup(order)
    del order.items
    found = session.query(User).first()
    found.delete()
    rows = User.objects.filter(a=1)
    rows.values()
    session.add(order)
    session.delete(Order())
    session.select(app.models.Item, "x")
    raw = dict(found)
    thing = user.copy()
    thing.save()
    x, y = Item(), 1
    for order in rows:
        order.validate()
    nothing.save()

class Service:
    def run(self):
        item: Item = Item(1)
        item = None
        def inner():
            item.json()
        return item
'''

FIELDS = '''
from .models import User, Order as Sale
from app import models
import app.models as am
from typing import Optional

class A:
    owner: Optional[User]
    sales: list["Sale"]
    other: "models.Item | None"
    far: am.Item
    own: B
    twin: Twin
    low: dict[str, item]
    plain: int
    bad: "a b"
    nothing = 3

class B:
    a: tuple[int, A]
'''


def test_usage_by_hand(spark):
    files = spark.createDataFrame([("app/api.py", USES), ("bad.py", "def ("), ("none.py", None)], "path string, text string")
    models = spark.createDataFrame([(1, "app.models", "User"), (2, "app.models", "Order"), (3, "app.models", "Item"), (4, "z", "User")], "model_id int, module string, name string")
    got = {(r["qualname"], r["model_id"], r["usage"]): (r["lines"], r["uses"]) for r in M.model_usage(files, models, examples=9).collect()}
    want = {
        ("handler", 1): {"update": [3], "read": [4, 9, 10, 11, 12, 17], "delete": [10], "serialize": [12, 16]},
        ("handler", 2): {"create": [5, 14], "update": [6], "read": [6, 8, 21], "serialize": [7, 13], "delete": [8, 13], "validate": [21]},
        ("handler", 3): {"create": [5, 19], "read": [15]},
        ("Service.run", 3): {"create": [26], "serialize": [29], "read": [29]},  # a later None doesn't free the variable
    }
    assert got == {(*k, usage): (lines, len(lines)) for k, v in want.items() for usage, lines in v.items()}
    few = M.model_usage(files, models, examples=2).where("qualname = 'handler' and model_id = 1 and usage = 'read'").first()
    assert (few["lines"], few["uses"]) == ([4, 9], 6)


def test_names_are_resolved_in_the_stated_order(spark):
    models = spark.createDataFrame([(1, "a", "User"), (2, "b", "user"), (3, "a.user", "X"), (4, "c", "User")], "model_id int, module string, name string")
    names = ["User", "user", "USER", "a.User", "A.USER", "q.User", "q.uSER", "nobody", "c.User", "a.user.X"]
    got = {r["name"]: r["model_id"] for r in M.resolve_names(spark.createDataFrame([(n,) for n in names], "name string"), models).collect()}
    assert got == {"User": 1, "user": 2, "USER": 1, "a.User": 1, "A.USER": 1, "q.User": 1, "q.uSER": 1, "c.User": 4, "a.user.X": 3}


def test_relationships_by_hand(spark):
    files = spark.createDataFrame([("app/shop.py", FIELDS), ("bad.py", "class")], "path string, text string")
    models = spark.createDataFrame(
        [(1, "app.models", "User"), (2, "app.models", "Order"), (3, "app.models", "Item"), (4, "z", "User"), (5, "app.shop", "A"), (6, "app.shop", "B"), (7, "x", "Twin"), (8, "y", "Twin"), (9, "s", "Sale")],
        "model_id int, module string, name string",
    )
    got = {(r["qualname"], r["field"]): (r["symbol"], r["target"], r["multiplicity"]) for r in M.model_relationships(files, models).collect()}
    assert got == {
        ("A", "owner"): ("User", 1, "one"), ("A", "sales"): ("Sale", 9, "many"), ("A", "other"): ("models.Item", 3, "one"), ("A", "far"): ("am.Item", 3, "one"), ("A", "own"): ("B", 6, "one"),
        ("A", "low"): ("item", 3, "one"), ("B", "a"): ("A", 5, "many"),
    }

"""Operators against brute force on small, skewed inputs."""

import datetime as dt
import itertools
import random

from pyspark.sql import functions as F

from stayline.operators import chains, checks, identity, lookup, privacy, quality, ranking, rollups
from stayline.sources import grid, links

DAY = dt.date(2020, 1, 1)


def test_global_rank_with_one_value_holding_most_rows(spark):
    rng = random.Random(1)
    data = [(f"c{i:04d}", 0.5 if i % 3 else rng.random()) for i in range(3000)]
    df = spark.createDataFrame(data, "id string, p double").repartition(7)
    got = {r.id: r["rank"] for r in ranking.global_rank(df, [F.desc("p")], "id").collect()}
    expected = {k: n for n, (k, _) in enumerate(sorted(data, key=lambda x: (-x[1], x[0])), 1)}
    assert got == expected


def test_surrogate_ids_follow_first_appearance(spark, rows):
    df = spark.createDataFrame([("b", 1), ("a", 2), ("b", 3), ("c", 1)], "vin string, at int")
    got = ranking.surrogate_ids(df, "vin", "at", "VEH", "vid", 4)
    assert rows(got, "vin", "vid") == [("a", "VEH0003"), ("b", "VEH0001"), ("c", "VEH0002")]


def test_day_chain_equals_a_plain_walk(spark):
    rng = random.Random(2)
    data = [
        ("hot" if i % 3 else f"v{i % 5}", DAY + dt.timedelta(days=rng.randint(0, 20)), f"s{i:04d}", float(rng.randint(0, 9)))
        for i in range(600)
    ]
    undated = [("hot", None, "u1", 1.0), (None, DAY, "u2", 1.0)]
    df = spark.createDataFrame(data + undated, "vin string, day date, id string, bill double").repartition(5)
    got = {r.id: r for r in chains.day_chain(df, "vin", "day", "id", previous=("bill", "day"), running=("bill",)).collect()}
    assert len(got) == len(data) + 2 and got["u1"].ordinal is None and got["u2"].running_bill is None
    for _, group in itertools.groupby(sorted(data), key=lambda x: x[0]):
        total, before = 0.0, None
        for n, (_, day, key, bill) in enumerate(sorted(group, key=lambda x: (x[1], x[2])), 1):
            total += bill
            r = got[key]
            assert (r.ordinal, r.running_bill) == (n, total)
            assert (r.prev_bill, r.prev_day) == ((before[1], before[0]) if before else (None, None))
            before = (day, bill)


def test_policy_chain(spark):
    data = [("i1", "v", DAY, DAY + dt.timedelta(365)), ("i2", "v", DAY + dt.timedelta(366), DAY + dt.timedelta(731))]
    df = spark.createDataFrame(data, "ins_id string, vin string, policy_issue_date date, policy_expiry_date date")
    first, second = chains.policy_chain(df).orderBy("ins_id").collect()
    assert first.previous_start is None and first.third_party_expiry == DAY + dt.timedelta(1095)
    assert second.previous_end == second.policy_issue_date and second.days_after_previous == 1
    assert second.previous_start == second.policy_issue_date - dt.timedelta(365)
    assert first.next_start == second.policy_issue_date


def test_plotted_points_equal_a_replay(spark):
    rng = random.Random(3)
    actions = []
    for i in range(400):
        kind = rng.random()
        label = None if kind < 0.5 else rng.choice(["State 1", "State 2"])
        actions.append(("hot" if i % 4 else f"u{i % 3}", i, kind > 0.93, None if kind > 0.93 else label))
    df = spark.createDataFrame(actions, "s string, at int, is_clear boolean, label string")
    shown: dict = {}
    counter: dict = {}
    for s, at, clear, label in actions:
        if clear:
            shown[s], counter[s] = [], 0
            continue
        if label is None:
            counter[s] = counter.get(s, 0) + 1
            label = f"P{counter[s]}"
        kept = [p for p in shown.get(s, []) if p[0] != label] + [(label, at)]
        shown[s] = kept[-6:]
    expected = sorted((s, label, at) for s, points in shown.items() for label, at in points)
    withat = df.withColumn("seen", F.col("at"))
    got = chains.plotted_points(withat, "s", ["at"]).select("s", "label", "seen").collect()
    assert sorted(tuple(r) for r in got) == expected


def test_neighbours_across_buckets(spark):
    rng = random.Random(4)
    known = sorted(rng.sample(range(0, 5000), 60))
    asked = rng.sample(range(0, 6000), 300) + known[:10]
    got = {
        r.number: (r.before, r.after)
        for r in lookup.neighbours(
            spark.createDataFrame([(n,) for n in asked * 3], "number bigint"),
            spark.createDataFrame([(n,) for n in known * 2], "number bigint"),
            bucket=50,
        ).collect()
    }
    for n in set(asked):
        lower, upper = [k for k in known if k < n], [k for k in known if k > n]
        assert got[n] == (max(lower) if lower else None, min(upper) if upper else None)


def test_lookup_takes_the_first_row_and_compares_text(spark, rows):
    decisions = spark.createDataFrame(
        [(1, "IRL00000010", "Approved"), (2, "00000010", "Refused"), (3, "30", "Granted"), (4, "abc", "Refused")],
        "row_idx bigint, application_number string, decision string",
    )
    searches = spark.createDataFrame([("a", "irl00000010"), ("b", "00000030"), ("c", "00000020"), ("d", "x")], "search_id string, raw string")
    assert rows(lookup.exact_matches(searches, decisions), "search_id", "status", "decision") == [
        ("a", "found", "Approved"), ("b", "not_found", None), ("c", "not_found", None), ("d", "invalid", None)
    ]
    assert rows(lookup.nearest_matches(searches, decisions, 7), "search_id", "nearest_application", "application_number", "difference") == [
        ("b", "Before", "IRL00000010", 20), ("c", "After", "30", 10), ("c", "Before", "IRL00000010", 10)
    ]


def test_decision_stats_count_the_second_label_only_without_the_first(spark):
    df = lambda *d: spark.createDataFrame([(x,) for x in d], "decision string")
    both = rollups.decision_stats(df("Approved", "Granted", "Rejected", "Rejected")).first()
    assert (both.total, both.approved, both.refused, both.approval_pct) == (4, 1, 2, 25.0)
    empty = rollups.decision_stats(df("x").where("false")).first()
    assert (empty.total, empty.approval_pct, empty.refused_pct) == (0, 0.0, 0.0)


def test_similar_names_equal_all_pairs(spark):
    rng = random.Random(5)
    names = {"".join(rng.choice("ab") for _ in range(rng.randint(1, 5))) for _ in range(40)}

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, old = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
        return row[-1]

    df = spark.createDataFrame([(n,) for n in names for _ in range(4)], "cust_name string")
    got = sorted(tuple(r) for r in identity.similar_names(df).collect())
    assert got == sorted((a, b) for a in names for b in names if a < b and distance(a, b) == 1)


def test_fallback_match_keeps_every_row(spark, rows):
    vehicle = spark.createDataFrame([("V1", "vin1", "e1", "r1"), ("V2", "vin2", "e2", "r2")], "vehicle_id string, vin string, engine_no string, reg_no string")
    feed = spark.createDataFrame(
        [("1", "vin1", "e2", "r2"), ("2", None, "e2", "r2"), ("3", "zzz", "e1", "r1"), ("4", None, None, "r1"), ("5", None, "e1", "r2")],
        "smr_id string, vin string, engine_no string, reg_no string",
    )
    assert rows(identity.match_vehicles(feed, vehicle, "smr_id"), "smr_id", "vehicle_id", "match_kind") == [
        ("1", "V1", "vin"), ("2", "V2", "engine_reg"), ("3", "V1", "engine_reg"), ("4", None, "none"), ("5", None, "none")
    ]


def test_leak_scan_handles_names_of_any_length(spark, rows):
    vault = spark.createDataFrame([("Rahul Sharma",), ("Prince",), ("Anna Maria von Berg",), ("Bo",)], "cust_name string")
    facts = spark.createDataFrame(
        [("call Rahul Sharma now", "x"), ("Rahul K. Sharma", "Bo"), ("Prince", "y"), ("Anna Maria Berg", "y"), ("to Anna Maria von Berg.", "y"), ("Prince", "z"),
         ("x_Rahul Sharmas", None), (None, "Princess")],
        "note string, other string",
    )
    assert rows(privacy.leak_scan(vault, {"f": facts})) == [
        ("f", "note", "Anna Maria von Berg", 1), ("f", "note", "Prince", 2), ("f", "note", "Rahul Sharma", 2), ("f", "other", "Prince", 1)
    ]


def test_vault_split_and_erasure(star):
    vault, masked = privacy.split(star.pii_vault)
    assert "cust_name" in vault.columns and not {"cust_name", "mobile_1", "email", "dob", "address"} & set(masked.columns)
    one = vault.limit(1)
    left = privacy.erase(vault, one)
    assert left.count() == vault.count() - 1
    assert privacy.reveal(masked, vault).columns == masked.columns


def test_quality_rules(spark, rows):
    banks = spark.createDataFrame([("BNK001",)], "bank_id string")
    good = "MA3" + "0" * 14
    feed = spark.createDataFrame(
        [
            ("S1", good, "01-01-2020", "02-01-2020", "Y", "BNK001"),
            ("S2", good, "03-01-2020", "02-01-2020", "N", None),
            ("S3", good, "31-02-2020", "02-01-2020", "N", None),
            ("S4", good[:-1], "01-01-2020", "02-01-2020", "Y", None),
            (None, good, "01-01-2020", "02-01-2020", "N", None),
            ("S5", good, "01-01-2020", "02-01-2020", "N", None),
            ("S5", good, "01-01-2020", "02-01-2020", "N", None),
        ],
        "sales_id string, vin string, sale_date string, delivery_date string, finance_flag string, bank_id string",
    )
    marked = quality.check_sales(feed, banks)
    got = sorted((str(r.sales_id), tuple(r.rejects)) for r in marked.collect())
    assert got == [
        ("None", ("sales_id missing",)), ("S1", ()), ("S2", ("sale_date after delivery",)), ("S3", ("sale_date invalid",)),
        ("S4", ("vin malformed", "bank_id unknown")), ("S5", ("sales_id not unique",)), ("S5", ("sales_id not unique",)),
    ]
    assert quality.accepted(marked).count() + quality.rejected(marked).count() == feed.count()


def test_median_with_even_and_odd_counts(spark, rows):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", 2.0), ("a", 9.0), ("b", 5.0), ("b", None), ("c", 1.0), ("c", 4.0)], "g string, v double")
    assert rows(rollups.median_by(df, ["g"], "v")) == [("a", 2.0), ("b", 5.0), ("c", 2.5)]


def test_checks_count_nulls_as_violations(spark, rows):
    df = spark.createDataFrame([(1,), (None,), (7,)], "x int")
    assert rows(checks.violations(df, "t", {"small": F.col("x") < 5, "any": F.lit(True)})) == [("t", "any", 0), ("t", "small", 2)]


def test_key_sets_and_subsets(spark):
    a, b = (spark.createDataFrame([(x,) for x in s], "k string") for s in ("aab", "bc"))
    r = checks.key_sets(a, b, "k").first()
    assert (r.left_only, r.right_only, r.left_rows, r.right_rows) == (1, 1, 3, 2)
    assert checks.subset_violations(a, b, "k").first().violations == 1


def test_grid_with_preamble_and_repeats(spark, rows):
    data = [
        ("f", 0, ["Decisions", None, None, None]), ("f", 1, None), ("f", 2, ["", "No", "APPLICATION NUMBER ", "Decision"]),
        ("f", 3, ["", "1", " 123 ", "Approved "]), ("f", 4, [None, None, None, None]), ("f", 5, ["", "No", "Application Number", "Decision"]),
        ("f", 6, ["", "2", "456", None]), ("f", 7, ["short"]), ("g", 0, ["nothing here"]),
    ]
    df = spark.createDataFrame(data, "file_id string, row_idx int, cells array<string>")
    assert rows(grid.clean_grid(df), "row_idx", "application_number", "decision") == [(3, "123", "Approved"), (6, "456", None)]
    assert rows(grid.files_without_header(df)) == [("g",)]
    titled = spark.createDataFrame([("s", 0, ["id", "x"]), ("s", 1, ["key", "note"]), ("s", 2, ["a", "1"]), ("s", 3, [None, None])], "file_id string, row_idx int, cells array<string>")
    assert rows(grid.sheet_table(titled, ["id", "x"]), "id", "x") == [("a", "1")]


def test_first_link_of_a_page(spark):
    html = (
        '<!-- <a href="/no">Visa decisions made from 1 January</a> --><a class="x" href="other">News of January</a>'
        '<a href=\'files/d.ods?v=1&amp;w=2\'><b>Visa decisions made from</b> 1 January 2026</a><a href="/late">Visa decisions made from January</a>'
    )
    df = spark.createDataFrame([(1, "https://a.example/en/page/", html), (2, "https://b.example/", "<a href='/q'>x</a>")], "page_id int, url string, html string")
    found = links.first_link(df).collect()
    assert [tuple(r) for r in found] == [(1, "https://a.example/en/page/files/d.ods?v=1&w=2", "Visa decisions made from 1 January 2026")]


def test_links_of_all_forms(spark):
    from stayline.sources import links

    html = (
        '<a data-href="/wrong" href="/right">a</a><a href=/bare>b</a><a class=x href=\'/single\'>c</a>'
        '<A HREF = "/q?x=1&#x26;y=2&amp;z">d &#233;&#x1F600;&#xD800;</A><a>none</a>'
    )
    found = links.anchors(spark.createDataFrame([(1, "http://a", html)], "page_id long, url string, html string")).orderBy("pos").collect()
    assert [(r.href, r.text) for r in found] == [
        ("/right", "a"), ("/bare", "b"), ("/single", "c"), ("/q?x=1&y=2&z", "d é😀�"), ("", "none")
    ]


def test_a_given_label_and_a_counted_one_are_one(spark):
    from stayline.operators import chains

    points = [(1, i, False, "P2" if i == 4 else None, float(i)) for i in range(1, 4)] + [(1, 4, False, "P2", 4.0)]
    table = spark.createDataFrame(points, "s long, at long, is_clear boolean, label string, v double")
    found = chains.plotted_points(table, "s", ["at"])
    assert sorted((r.label, r.v) for r in found.collect()) == [("P1", 1.0), ("P2", 4.0), ("P3", 3.0)]


def test_equal_rows_count_in_a_table_hash(spark):
    from stayline.operators import checks

    one, two = (checks.table_hash(spark.createDataFrame([(n,), (n,)], "x int"), "t").first() for n in (1, 2))
    assert one.content_hash != two.content_hash and one.rows == two.rows == 2
    assert checks.table_hash(spark.createDataFrame([], "x int"), "t").first().content_hash == "0"


def test_long_prefixed_numbers_are_not_cut(spark):
    from stayline.functions.application import with_number_check

    table = spark.createDataFrame([("IRL" + "1" * 1_000_001,)], "raw string")
    assert "1000001" in with_number_check(table, "raw").first().error_msg


def test_median_by_selection_rounds(spark):
    import random
    import statistics

    random.seed(5)
    data = [("hot", random.random() * 1e6) for _ in range(3000)]  # a large group of continuous values
    data += [("ties", float(random.choice([1, 2, 2, 3]))) for _ in range(501)]
    data += [("same", 7.25)] * 40 + [("one", -3.5), ("pair", 1.0), ("pair", 2.0), ("tiny", 1e-300), ("tiny", 2e-300), ("tiny", 3e-300)]
    data += [("nulls", None), ("hot", None)]
    df = spark.createDataFrame(data, "g string, v double")
    got = {r.g: r.median_v for r in rollups.median_by(df, ["g"], "v", buckets=4, tail=5).collect()}
    want = {g: statistics.median([v for h, v in data if h == g and v is not None]) for g in {h for h, v in data if v is not None}}
    assert got == want


def test_neighbours_carry_across_range_partitions(spark):
    import bisect
    import random

    from stayline.operators import lookup

    random.seed(11)
    digits = [random.randrange(1, 19) for _ in range(300)]
    decided = [random.randrange(10 ** (d - 1), 10**d) for d in digits] + [5, 5, 10**17]
    asked = [random.randrange(0, 10**18) for _ in range(400)] + [5, 4, 6, 10**17, 10**17 + 1, 0] + decided[:20]
    known = sorted(set(decided))
    got = {r.number: (r.before, r.after) for r in lookup.neighbours(
        spark.createDataFrame([(a,) for a in asked], "number long"), spark.createDataFrame([(d,) for d in decided], "number long")).collect()}
    for a in set(asked):
        at = bisect.bisect_left(known, a)
        before = known[at - 1] if at > 0 else None
        after_at = bisect.bisect_right(known, a)
        after = known[after_at] if after_at < len(known) else None
        assert got[a] == (before, after), a
    assert len(got) == len(set(asked))


def test_checked_load_reports_what_does_not_fit(spark):
    from stayline.session import staged_path
    from stayline.sources import tables as loading
    from stayline.schemas import TABLES

    folder = staged_path(spark, "load")
    declared = TABLES["customer"]
    row = {f.name: None for f in declared.fields} | {"cust_id": "C1", "birth_year": "1980"}
    frame = spark.createDataFrame([row], declared).drop("city").withColumn("nickname", F.lit("x"))
    frame.write.parquet(f"{folder}/customer.parquet")
    spark.createDataFrame([("junk",)], "value string").write.text(f"{folder}/vehicle.parquet")  # a folder of text, no Parquet
    tables, report = loading.load_checked(spark, folder, ["customer", "vehicle", "sales"])
    got = sorted((r.table_name, r.item, r.finding) for r in report.collect())
    assert ("customer", "city", "missing column") in got and ("customer", "nickname", "extra column") in got
    assert ("customer", "customer", "rows") in got and ("sales", "sales", "missing table") in got
    assert ("vehicle", "vehicle", "missing table") in got and any(t == "vehicle" and f == "unreadable file" for t, _, f in got)
    assert tables["customer"].columns == declared.fieldNames() and tables["customer"].first().city is None
    assert set(tables) == {"customer"}


def test_key_sets_count_null_keys_on_each_side(spark):
    left = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "k string")
    right = spark.createDataFrame([("a",), ("c",), (None,), (None,)], "k string")
    got = checks.key_sets(left, right, "k").first()
    assert (got.left_only, got.right_only, got.left_rows, got.right_rows) == (2, 2, 4, 4)  # b and null; c and null


def _plan(df):
    return df._jdf.queryExecution().toString()


def test_leak_scan_shuffles_no_text(spark, rows):
    vault = spark.createDataFrame([("Zoë Ünal",), ("名前山田",), ("Customer 1",), ("Customer 12",), (None,)], "cust_name string")
    facts = spark.createDataFrame([("x名前山田y", 1), ("zoë ünal Zoë Ünal Zoë Ünal", 2), ("Customer 123", 3), ("Customer 123", 4), ("", 5), (None, 6)], "note string, n int")
    found = privacy.leak_scan(vault, {"f": facts, "numbers": facts.select("n")})
    assert rows(found, "column_name", "name", "leaked_rows") == [
        ("note", "Customer 1", 2), ("note", "Customer 12", 2), ("note", "Zoë Ünal", 1), ("note", "名前山田", 1)
    ]
    assert "gram" not in _plan(found) and "Explode" not in _plan(found)


def test_orphan_keys_broadcast_no_side(spark, rows):
    fact = spark.createDataFrame([("a",), ("a",), ("b",), (" ",), (None,)], "k string")
    target = spark.createDataFrame([("b",), ("c",), (None,)], "k string")
    found = checks.orphan_keys(fact, "k", target, "k")
    assert rows(found) == [("a",)]
    assert "Join" not in _plan(found)


def test_copies_carry_no_unread_column(spark, rows):
    df = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "x"), (None, "x"), (None, "x"), ("", "x")], "k string, wide string")
    counted = quality.with_copies(df, "k")
    assert rows(counted.select(F.coalesce("k", F.lit("-")), "copies")) == [("", 1), ("-", 1), ("-", 1), ("a", 2), ("a", 2), ("b", 1)]
    plan = counted.select("copies")._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.splitlines() if "wide" in line and "LogicalRDD" not in line]  # only the source has it

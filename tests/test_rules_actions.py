"""Rule text and action documents."""

import json

import pytest

from conftest import SF_DIR, plan, rows
from flowlantern.operators import actions, alerts, catalogues, rules
from flowlantern.plans import queries


def lines(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "line_no long, line string")


def test_parse_a_plain_rule(spark):
    parsed = rules.parse_rules(lines(spark, 'drop sctp any any -> any any (msg:"no such thing here"; sid:77; rev:4;)'))
    columns = ["action", "proto", "src", "sport", "direction", "dst", "dport", "msg", "sid", "rev"]
    assert rows(parsed, *columns) == [("drop", "sctp", "any", "any", "->", "any", "any", "no such thing here", 77, 4)]


def test_negated_lists_and_unread_rules(spark):
    table = lines(
        spark,
        'alert tcp ![10.0.0.0/8, 172.28.0.0/16] ![22, 23] -> any any (sid:1;)',
        "alert tcp any any any any (sid:2;)",
        "# alert tcp any",
        "  ",
        None,
    )
    assert rows(rules.parse_rules(table), "line_no", "src", "sport") == [(0, "![10.0.0.0/8, 172.28.0.0/16]", "![22, 23]")]
    assert rows(rules.unparsed_rules(table), "line_no") == [(1,)]


def test_parse_odd_rules(spark):
    table = lines(
        spark,
        '#alert tcp any any -> any any (msg:"off"; sid:1;)',
        "not a rule",
        "",
        r'alert tcp [1.2.3.0/24, !10.0.0.1] [1:5, 7] <> $HOME_NET any (msg:"a \; sid:9; b"; sid:3; rev:x;)',
        'alert tcp any any -> any any (content:"x";)',
    )
    parsed = rules.parse_rules(table)
    assert rows(parsed, "line_no", "src", "sport", "msg", "sid", "rev") == [
        (3, "[1.2.3.0/24, !10.0.0.1]", "[1:5, 7]", r"a \; sid:9; b", 3, None),
        (4, "any", "any", None, None, None),
    ]


def test_references_of_a_rule_become_links(spark):
    table = lines(spark, 'alert tcp any any -> any any (msg:"m"; reference:cve,2024-1; reference:url,a.b/c; sid:5; rev:1;)')
    dim = catalogues.reference_dim(lines(spark, "config reference: cve http://cve?name=", "config reference: url http://"))
    links = alerts.enrich_reference(rules.rule_references(rules.parse_rules(table)), dim)
    assert rows(links, "sid", "reference_url") == [(5, "http://a.b/c"), (5, "http://cve?name=2024-1")]


def test_prune_and_disable(spark):
    texts = [
        'alert dnp3 any any -> any any (msg:"a"; sid:1;)',
        'alert tcp any any -> any any (msg:"on dnp3 port"; sid:2;)',
        'alert tcp any any -> any any (msg:"dnp3"; sid:3;)',
        '#alert dnp3 any any -> any any (sid:4;)',
        "# alert about dnp3 (text)",
        "drop dnp3 any",
        None,
    ]
    table = lines(spark, *texts)
    # As a word between spaces or at the start of an alert.
    assert rows(rules.prune_rules(table), "line_no") == [(2,), (6,)]
    changed = [row[0] for row in rows(rules.disable_rules(table), "line_no", "line") if row[1] != texts[row[0]]]
    # A parenthesis has to follow the word; an already commented line is commented again.
    assert changed == [0, 3, 4]


DOCUMENT = json.dumps([{"comando": "nft add"}, {"comando": "killall x"}, {"x": 1}, {"comando": ""}])


def documents(spark, *bodies):
    return spark.createDataFrame(list(enumerate(bodies)), "doc_id long, body string")


def test_verdicts(spark):
    items = actions.actions(documents(spark, DOCUMENT))
    assert rows(actions.action_verdict(items, "prefix"), "pos", "verdict") == [(0, "denied"), (1, "allowed"), (2, "denied")]
    assert rows(actions.action_verdict(items, "word"), "pos", "verdict") == [(0, "allowed"), (1, "denied"), (2, "denied")]
    assert rows(actions.strict_prefix(documents(spark, DOCUMENT)), "pos", "comando") == [(0, "nft add")]


@pytest.mark.parametrize(
    ("commands", "run"),
    [
        (["nft a", "kill 1"], [0, 1]),
        (["rm x", "nft a"], []),
        (["", "nft a", "", "rm x", "nft b"], [1]),
        (["kill", "nft a"], []),
        (["kill\t1"], [0]),
        ([], []),
    ],
)
def test_first_denied_command_stops_the_rest(spark, commands, run):
    body = json.dumps([{"comando": command} for command in commands])
    assert [row[0] for row in rows(actions.strict_prefix(documents(spark, body)), "pos")] == run


def test_odd_items_are_skipped_and_objects_iterated(spark):
    table = documents(spark, '["x",{"comando":"kill 1"},null,[1],3]', '{"a":{"comando":"kill 2"},"b":7}', "5", "{}", "[]")
    assert rows(actions.actions(table), "doc_id", "pos", "comando") == [(0, 1, "kill 1"), (1, 0, "kill 2")]
    assert rows(actions.strict_prefix(table)) == [(0, 1, "kill 1"), (1, 0, "kill 2")]
    assert rows(actions.odd_items(table), "doc_id", "pos") == [(0, 0), (0, 2), (0, 3), (0, 4), (1, 1)]


def test_only_whole_documents_are_used(spark):
    table = documents(spark, "[]", DOCUMENT, DOCUMENT[:-1], "", None, "{}")
    assert rows(actions.valid_actions(table), "doc_id") == [(0,), (1,), (5,)]


def test_strict_word_implies_loose_prefix_except_nft(spark):
    items = actions.actions(queries._documents(spark, SF_DIR))
    word = actions.action_verdict(items, "word").filter("verdict = 'allowed' AND comando NOT LIKE 'nft%'")
    loose = actions.action_verdict(items, "prefix").filter("verdict = 'allowed'")
    assert word.join(loose, ["doc_id", "pos"], "left_anti").count() == 0


def test_documents_are_judged_without_a_shuffle(spark):
    table = documents(spark, DOCUMENT)
    assert "Exchange" not in plan(actions.strict_prefix(table))
    assert "Exchange" not in plan(actions.action_verdict(actions.actions(table)))

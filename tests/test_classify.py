from __future__ import annotations

import json
from decimal import Decimal

import pytest

from tillstream.operators.classify import check_shape, classify, valid_events

VALID, UNPARSEABLE, FAILED = "VALID", "UNPARSEABLE", "VALIDATION_FAILED"


def outcomes(frame):
    rows = classify(frame).orderBy("offset").collect()
    return [(r.outcome, list(r.errors)) for r in rows]


def test_validator_cases(messages, event):
    """Clean, messy but good, and the four ways to fail: two of six are accepted."""
    found = outcomes(messages([
        event(),
        event(event_type="purchase", quantity="3", unit_price="49.99"),
        event(event_type="PRODUCT_VIEW", event_id="DROP", quantity="DROP", unit_price="DROP"),
        event(event_type="ADD_TO_CART", quantity="INVALID", unit_price="DROP"),
        event(timestamp="not-a-timestamp"),
        event(event_type="UNKNOWN_EVENT"),
    ]))
    assert found == [
        (VALID, []), (VALID, []),
        (FAILED, ["missing required fields: ['event_id']"]),
        (FAILED, ["invalid quantity: 'INVALID'"]),
        (FAILED, ["invalid timestamp: 'not-a-timestamp'"]),
        (FAILED, ["unknown event_type: 'UNKNOWN_EVENT'"]),
    ]


def test_normalised_values(messages, event):
    row = valid_events(classify(messages([
        event(event_type=" purchase\t", quantity=" 3 ", unit_price="49.99")]))).first()
    assert (row.event_type, row.quantity, row.unit_price) == ("PURCHASE", 3, Decimal("49.99"))
    assert (row.kafka_partition, row.kafka_offset) == (0, 0)


CASES = [
    # changes, errors
    ({"event_type": "it's"}, ['unknown event_type: "IT\'S"']),
    ({"event_type": 'a"b\'c'}, ["unknown event_type: 'A\"B\\'C'"]),
    ({"event_type": "a\\b\n"}, ["unknown event_type: 'A\\\\B'"]),
    ({"event_type": None}, ["unknown event_type: None"]),
    ({"event_type": "DROP"}, ["unknown event_type: None"]),
    ({"event_type": 5}, ["unknown event_type: 5"]),
    ({"event_type": True}, ["unknown event_type: True"]),
    ({"event_id": None}, ["empty event_id"]),
    ({"event_id": 0}, ["empty event_id"]),
    ({"event_id": False}, ["empty event_id"]),
    ({"event_id": ""}, ["empty event_id"]),
    ({"event_id": []}, ["empty event_id"]),
    ({"event_id": "0"}, []),
    ({"event_id": "false"}, []),
    ({"user_id": None}, []),
    ({"user_id": "DROP", "product_id": "DROP"},
     ["missing required fields: ['product_id', 'user_id']"]),
    ({"user_id": "DROP", "timestamp": "x", "quantity": -1, "unit_price": 0},
     ["missing required fields: ['user_id']", "invalid timestamp: 'x'", "invalid quantity: -1",
      "invalid unit_price: 0.0"]),
    ({"quantity": True}, ["invalid quantity: True"]),
    ({"quantity": "true"}, ["invalid quantity: 'true'"]),
    ({"quantity": 3.0}, ["invalid quantity: 3.0"]),
    ({"quantity": "3.0"}, ["invalid quantity: '3.0'"]),
    ({"quantity": None}, ["invalid quantity: None"]),
    ({"quantity": 0}, ["invalid quantity: 0"]),
    ({"quantity": "+7"}, []),
    ({"quantity": " 7\t"}, []),
    ({"quantity": 2147483648}, ["quantity out of range: 2147483648"]),
    ({"unit_price": True}, ["invalid unit_price: True"]),
    ({"unit_price": "N/A"}, ["invalid unit_price: 'N/A'"]),
    ({"unit_price": "-1"}, ["invalid unit_price: -1.0"]),
    ({"unit_price": -1e20}, ["invalid unit_price: -1e+20"]),
    ({"unit_price": -0.00005}, ["invalid unit_price: -5e-05"]),
    ({"unit_price": -0.00015}, ["invalid unit_price: -0.00015"]),
    ({"unit_price": -123456789.5}, ["invalid unit_price: -123456789.5"]),
    ({"unit_price": "3d"}, ["invalid unit_price: '3d'"]),
    ({"unit_price": "1e2"}, []),
    ({"unit_price": 1e9}, ["unit_price out of range: 1000000000.0"]),
    ({"timestamp": None}, ["invalid timestamp: None"]),
    ({"timestamp": 5}, ["invalid timestamp: 5"]),
    ({"timestamp": "2024-1-5t1:2:3z"}, []),
    ({"timestamp": "2024-02-30T00:00:00Z"}, ["invalid timestamp: '2024-02-30T00:00:00Z'"]),
    ({"timestamp": "0000-01-01T00:00:00Z"}, ["invalid timestamp: '0000-01-01T00:00:00Z'"]),
    ({"timestamp": "2024-01-15T24:00:00Z"}, ["invalid timestamp: '2024-01-15T24:00:00Z'"]),
    ({"timestamp": "2024-01-15T10:00:00Z\n"}, ["invalid timestamp: '2024-01-15T10:00:00Z\\n'"]),
    ({"timestamp": "2024-01-15T10:00:00Z\r"}, ["invalid timestamp: '2024-01-15T10:00:00Z\\r'"]),
    ({"timestamp": "2024-01-15T10:00:00"}, ["invalid timestamp: '2024-01-15T10:00:00'"]),
    # Fields the type does not need: anything that fits the column passes.
    ({"event_type": "USER_SIGNUP", "quantity": -4, "unit_price": -3}, []),
    ({"event_type": "USER_SIGNUP", "quantity": None, "unit_price": None}, []),
    ({"event_type": "USER_SIGNUP", "quantity": "bad"}, ["invalid quantity: 'bad'"]),
    ({"event_type": "USER_SIGNUP", "unit_price": "bad"}, ["invalid unit_price: 'bad'"]),
]


def test_error_texts(messages, event):
    found = outcomes(messages([event(**changes) for changes, _ in CASES]))
    for (changes, errors), got in zip(CASES, found):
        assert got == (FAILED if errors else VALID, errors), changes


def test_unread_fraction_is_rounded(messages, event):
    rows = classify(messages([event(event_type="PRODUCT_VIEW", quantity=2.5)])).collect()
    assert [(r.outcome, r.quantity) for r in rows] == [(VALID, 3)]


def test_price_is_rounded_half_up(messages, event):
    assert classify(messages([event(unit_price=1.005)])).first().unit_price == Decimal("1.01")


@pytest.mark.parametrize("tail", ["\u2028", "\u2029", "\u0085", " x", "}", "]", ",", '{"a":1}', ',"a":1', "] {}", "} {}"])
def test_trailing_text_is_unparseable(messages, event, tail):
    payload = json.dumps(event())
    nested = json.dumps(event(extra={"deep": [1, {"x": "}{"}]}))
    assert outcomes(messages([payload + tail, nested + tail, nested + " \n"])) == [
        (UNPARSEABLE, ["malformed JSON payload"]), (UNPARSEABLE, ["malformed JSON payload"]),
        (VALID, [])]


def test_unreadable_payloads(messages, event):
    found = outcomes(messages([
        "", None, "[1]", "5", "null", "{'a': 1}", '{"a": NaN}', '{"a": 01}', '{"a": 1,}', '{"a',
        b'{"a": "\xff"}', "﻿" + json.dumps(event()), '{"a": "\t"}',
    ]))
    assert all(outcome == UNPARSEABLE for outcome, _ in found)
    assert found[1][1] == ["malformed JSON payload: no value"]
    assert found[2][1] == found[3][1] == found[4][1] == ["not a JSON object"]
    assert found[10][1] == ["malformed JSON payload: invalid UTF-8"]


def test_last_of_repeated_keys_counts(messages, event):
    payload = json.dumps(event())[:-1]
    found = outcomes(messages([
        payload + ', "event_type": null}', payload + ', "quantity": 0}', payload + ', "z": 1}']))
    assert found == [(FAILED, ["unknown event_type: None"]), (FAILED, ["invalid quantity: 0"]),
                     (VALID, [])]


def test_bad_rows_do_not_block_good_ones(messages, event):
    found = outcomes(messages(["{", event(event_type="x"), event()]))
    assert [outcome for outcome, _ in found] == [UNPARSEABLE, FAILED, VALID]


def test_each_payload_is_read_once(messages, event):
    """Filtering the result must not copy the parser into the filter."""
    rows = classify(messages([event()])).where("outcome = 'VALID' AND event_type = 'PURCHASE'")
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1


def test_shape(messages, event):
    rows = check_shape(messages([
        event(), event(user_id="DROP"), event(extra=1), event(quantity="2"), event(quantity=2.0),
        event(unit_price="1"), event(timestamp="2024-1-15T10:00:00Z"), event(event_type="nope"),
    ])).orderBy("offset").collect()
    assert [r.well_shaped for r in rows] == [True] + [False] * 7

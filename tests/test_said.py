"""Every outcome of the chat, lexicon and size rules occurs in the registered queries."""

import __spark_entry__ as E

SF = "/root/testdata/sf0.01"
QUERIES = E.queries()


def rows(spark, name):
    return QUERIES[name](spark, SF).collect()


def test_chat_outcomes_differ(spark):
    got = rows(spark, "chat_audit_said")
    assert {r.language for r in got} == {"mn", "en"} and {0, 1} <= {r.n_issues for r in got} and len({r.confidence for r in got}) > 2
    assert len({r.missing_application_fields for r in got}) > 10
    assert all(r.n_given and r.n_missing for r in rows(spark, "context_fields_said"))
    assert len({r.system_prompt for r in rows(spark, "chat_prompts_said")}) > 10


def test_lexicon_records_and_pairs(spark):
    assert all(r.n > 0 for r in rows(spark, "lexicon_usage_said"))
    got = rows(spark, "teacher_records_given")
    assert {r.domain for r in got} == {"legal", "finance", "lending"} and {r.language for r in got} == {"en", "mn"} and {r.contains_pii for r in got} == {True, False}
    got = rows(spark, "preference_pairs_said")
    assert len({(r.chosen_safe, r.rejected_unsafe) for r in got}) >= 3 and {r.pair_ok for r in got} == {True, False}


def test_size_rules_break(spark):
    got = rows(spark, "domain_rules_sets")
    assert {(r.missing, r.matches) for r in got} >= {(False, True), (False, False), (True, True)} and {r.total for r in got} >= {1500, 1400, 1350}
    got = rows(spark, "size_rules_sets")
    assert {(r.is_size, r.domains_known) for r in got} == {(True, True), (False, True), (True, False)} and {r.passes for r in got} == {True, False}

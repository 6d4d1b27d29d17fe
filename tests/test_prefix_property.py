"""The prefix rewrite (minimal cover + generated prefixes + equi-join) against its definition: an anchored,
case-insensitive regular-expression alternation over the full code list, one match per record."""

from __future__ import annotations

import re
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from phenolith.operators import codes as K
from phenolith.operators import extract as XT

CODE_SCHEMA = ("phenotype string, is_complex boolean, field string, field_id int, pos int, qual_type string, "
               "qual_field int, field_type string, code string, value string, ontology string, type string, "
               "group string")

codes_st = st.lists(st.text(alphabet="ABa1.", min_size=1, max_size=3).filter(lambda c: c.replace(".", "")),
                    min_size=1, max_size=5)
values_st = st.lists(st.text(alphabet="ABab12", min_size=0, max_size=4), min_size=1, max_size=12)


@settings(max_examples=10, deadline=None)
@given(codes_a=codes_st, codes_b=codes_st, values=values_st)
def test_prefix_join_equals_regex_alternation(spark, codes_a, codes_b, values):
    rows = [("pa", False, "41202", 41202, 0, None, None, None, c, "x", None, "any", None) for c in codes_a]
    rows += [("pb", False, "41202", 41202, 0, None, None, None, c, "x", None, "any", None) for c in codes_b]
    matches = K.match_table(spark.createDataFrame(rows, CODE_SCHEMA))
    recs = spark.createDataFrame([(i, 41202, v) for i, v in enumerate(values)],
                                 "rid int, field_id int, field_value string")
    got = Counter((r.rid, r.phenotype) for r in XT.match_prefix(recs, K.match_values(recs.select("field_id", "field_value").distinct(), matches, K.match_info(matches))).collect())

    want = Counter()
    for name, cs in (("pa", codes_a), ("pb", codes_b)):
        pattern = re.compile("^(" + "|".join(re.escape(c.replace(".", "")) for c in cs) + ")", re.IGNORECASE)
        for i, v in enumerate(values):
            if pattern.match(v):
                want[(i, name)] += 1
    assert got == want

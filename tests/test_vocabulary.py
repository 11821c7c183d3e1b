from footfall.operators.indicators import visitor_flags
from footfall.vocabulary import INDICATORS, STATES, VISITOR
from tests.hand_made import PARAMS, session, sessions


def test_sizes():
    assert len(INDICATORS) == len({i.column for i in INDICATORS}) == 111
    assert len(STATES) == len({name for name, _, _ in STATES}) == 54
    groups = [i.group for i in INDICATORS]
    assert [groups.count(g) for g in ("device", "browser", "channel", "page", "metro")] == [
        3,
        4,
        8,
        19,
        77,
    ]


def test_misspelt_columns_are_kept():
    columns = {i.literal: i.column for i in INDICATORS if i.group in ("channel", "metro")}
    assert columns["Referral"] == "channelGrouping_Referal"
    assert columns["Idaho Falls-Pocatello ID"] == "geoNetworkmetro_OdahoFallsPocatelloID"
    assert columns["Weeling WV-Steubenville OH"] == "geoNetworkmetro_WheelingWVSteubenvilleOH"
    assert columns["Hartford & New Haven CT"] == "geoNetworkmetro_HartfordNewHavenCT"


def _one_session_with(number, ind):
    values = {"device": None, "browser": None, "channel": None, "metro": None}
    page = (None, None)
    if ind.field == "hits.page.pagePathLevel2":
        page = (ind.literal, None)
    elif ind.field == "hits.page.pagePathLevel3":
        page = (None, ind.literal)
    else:
        values[ind.group] = ind.literal
    return session(str(number), hits=[page], **values)


def test_every_literal_sets_its_column_and_no_other(spark):
    rows = [_one_session_with(i, ind) for i, ind in enumerate(INDICATORS)]
    found = {r[VISITOR]: r for r in visitor_flags(sessions(spark, rows), PARAMS).collect()}
    assert len(found) == 111
    for i, ind in enumerate(INDICATORS):
        ones = [k for k, v in found[str(i)].asDict().items() if v == 1]
        assert ones == [ind.column]

import pytest

from flowtables.operators import fix

S = "\x01"
HEAD = "8=FIXT.1.1|35=8|34=7|52=20240105-10:11:12.345|"
EXECUTION = (HEAD + "37=order|17=execid|150=0|39=2|54=1|151=0|14=0|38=1.2|44=12.34|55=ISC|48=CUSIP|60=20240105-22:30:00|"
             "1102=12.4|1089=4.5|111=3.4|119=3.45|20034=cm|21100=lu|21101=uc|20015=op|20009=or|20199=oc|"
             "453=2|448=p1|447=D|448=p2|447=D|555=1|600=ls|602=li|637=7.8|1418=0.89|20200=lm|10=000|")
TRADE = ("8=FIXT.1.1|35=AE|34=9|52=20240105-10:11:12|571=tr|1003=ti|32=1|31=1|55=ISC|60=20240105-10:00:00.5|570=Y|"
         "552=2|54=2|1=acc|37=o1|54=1|70=al|10=000|").replace("10:00:00.5", "10:00:00.500")
QUOTE = "8=FIXT.1.1|35=AI|34=3|52=20240105-10:11:00|117=q|537=1|132=1.5|797=N|10=000|"


def messages(spark, *raw):
    return spark.createDataFrame([("s", r.replace("|", S)) for r in raw], "session string, raw string")


def test_execution_report(spark):
    r = fix.executions(messages(spark, EXECUTION, TRADE, QUOTE), hours=3).collect()
    assert len(r) == 1 and len(r[0]) == 51  # 50 report keys and the session
    r = r[0]
    assert (r.MsgType, r.OrderID, r.Price, r.OrderQty, r.Symbol, r.ListID, r.LeavesQty) == ("8", "order", 12.34, 1.2, "ISC", None, 0.0)
    assert (r.ComboMatchID, r.LastUnderlyingPx, r.UnderlyingColPx, r.OptPremiumAmt, r.OrderReference, r.OpenCloseIndicator) == (
        "cm", "lu", "uc", "op", "or", "oc")
    assert (r.TransactTime, r.TransactDate, r.Id) == ("2024-01-06T01:30:00.000", "2024-01-06", "7:order")
    assert [tuple(x) for x in r.NoLegs] == [("ls", "li", None, 7.8, 0.89, "lm")]
    assert r.MessageDropTime


def test_two_legs_and_counts(spark):
    two = HEAD + "60=20240105-10:00:00|555=2|600=a|637=1|600=b|1418=2|10=000|"
    legs = fix.executions(messages(spark, two)).first().NoLegs
    assert [(x.LegSymbol, x.LegLastPx, x.LegLastQty) for x in legs] == [("a", 1.0, None), ("b", None, 2.0)]
    none = fix.executions(messages(spark, HEAD + "60=20240105-10:00:00|10=000|")).first()
    assert none.NoLegs == [] and none.OrderID is None and none.Id == "7:null"


def test_trade_report(spark):
    r = fix.trades(messages(spark, EXECUTION, TRADE), zone="America/New_York").first()
    assert (r.TradeReportID, r.TradeID, r.LastQty, r.PreviouslyReported, r.SettlementPrice) == ("tr", "ti", 1.0, True, None)
    assert (r.TransactTime, r.TransactDate) == ("2024-01-05T05:00:00.500", "2024-01-05")
    assert [tuple(s) for s in r.NoSides] == [("2", "acc", "o1", None), ("1", None, None, "al")]
    assert len(fix.trades(messages(spark, TRADE)).columns) == 32  # 31 report keys and the session


def test_quote_report(spark):
    r = fix.quotes(messages(spark, QUOTE)).first()
    assert (r.QuoteID, r.QuoteType, r.BidPx, r.CopyMsgIndicator, r.TransactTime, r.Id) == ("q", 1, 1.5, False, "2024-01-05T10:11", "3:q")
    assert len(r) == 19  # 18 report keys and the session


@pytest.mark.parametrize("raw,kind,code,text", [
    (EXECUTION, "execution", None, None), (TRADE, "trade", None, None), (QUOTE, "quote", None, None),
    ("8=F|35=0|34=1|10=0|", "dropped", None, None),
    ("8=F|35=5|34=1|10=0|", "dropped", None, None),
    ("8=F|35=5|34=1|58=wrong password|10=0|", "failure", "LogonException", "wrong password"),
    (HEAD + "37=o|10=0|", "failure", "FieldNotFound", None),
    (HEAD + "60=yesterday|10=0|", "failure", "IncorrectDataFormat", None),
    (HEAD + "60=20240105-10:00:00|44=cheap|10=0|", "failure", "IncorrectDataFormat", None),
    (HEAD + "60=20240105-10:00:00|555=1|600=a|637=x|10=0|", "failure", "IncorrectDataFormat", None),
    ("8=F|35=AI|117=q|10=0|", "failure", "FieldNotFound", None),
    ("garbage", "failure", "FieldNotFound", None),
])
def test_routing(spark, raw, kind, code, text):
    df = messages(spark, raw)
    r = fix.route(df).first()
    assert (r.kind, r.error_code, r.error_text, r.raw) == (kind, code, text, raw.replace("|", S))
    assert fix.failures(df).count() == (kind == "failure")
    counts = (fix.executions(df).count(), fix.trades(df).count(), fix.quotes(df).count())
    assert counts == tuple(int(kind == k) for k in ("execution", "trade", "quote"))


def test_tags(spark):
    got = [(r.pos, r.tag, r.val) for r in fix.explode_tags(messages(spark, "8=F|35=8|58=a=b|junk|10=0|")).collect()]
    assert got == [(0, 8, "F"), (1, 35, "8"), (2, 58, "a=b"), (3, 10, "0")]


def test_sequence_gaps(spark):
    df = spark.createDataFrame([("a", s) for s in (1, 2, 5, 5, 6)] + [("b", 9)], "session string, seq long")
    for width in (2, 100):
        got = sorted((r.session, r.seq, r.prev_seq, r.missing) for r in fix.sequence_gaps(df, ["session"], "seq", width).collect())
        assert got == [("a", 5, 2, 2), ("a", 5, 5, -1)]


def test_texts_of_any_characters(spark):
    odd = ('8=FIXT.1.1|35=8|34=7|no tag|35|=x|060=1|60=20240105-10:00:00|37=first|37=a "b" \\ {c}, \t\n\\u0041|17=|39=2=3|55|'
           '555=2|600=l"1\\|602=|637=1|637=2|600=l,2}]|10=000|')
    r = fix.executions(messages(spark, odd)).first()
    assert (r.OrderID, r.ExecID, r.OrdStatus, r.Symbol) == ('a "b" \\ {c}, \t\n\\u0041', "", "2=3", None)
    assert [(x.LegSymbol, x.LegSecurityID, x.LegLastPx) for x in r.NoLegs] == [('l"1\\', "", 2.0), ("l,2}]", None, None)]


def test_a_message_is_not_searched_for_each_field(spark):
    plan = fix.executions(messages(spark, EXECUTION))._jdf.queryExecution().analyzed().toString()
    assert plan.count("substring_index(") <= 4

"""Field tables of the trading messages: (output name, tag, type)."""

from __future__ import annotations

from typing import NamedTuple

# --- fixed values: tag numbers and names --------------------------------------
SOH = "\x01"
MSG_TYPE, MSG_SEQ_NUM, SENDING_TIME, TRANSACT_TIME, TEXT = 35, 34, 52, 60, 58
EXECUTION_REPORT, TRADE_CAPTURE_REPORT, QUOTE_STATUS_REPORT, LOGOUT = "8", "AE", "AI", "5"
UTC_TIMESTAMP_FORMAT = "yyyyMMdd-HH:mm:ss"
UTC_TIMESTAMP_TEXT = r"^(\d{8}-\d\d:\d\d:\d\d)(?:\.(\d{1,9}))?$"


class Field(NamedTuple):
    name: str
    tag: int
    type: str = "string"


INSTRUMENT = (
    Field("Symbol", 55),
    Field("SecurityID", 48),
    Field("SecurityIDSource", 22),
)

EXECUTION_FIELDS = (
    Field("OrderID", 37),
    Field("ExecID", 17),
    Field("ListID", 66),
    Field("TrdMatchID", 880),
    Field("ComboMatchID", 20034),
    Field("ExecType", 150),
    Field("OrdStatus", 39),
    Field("Account", 1),
    *INSTRUMENT,
    Field("Side", 54),
    Field("OrderQty", 38, "double"),
    Field("OrdType", 40),
    Field("Price", 44, "double"),
    Field("LastUnderlyingPx", 21100),
    Field("UnderlyingColPx", 21101),
    Field("TriggerType", 1100),
    Field("TriggerAction", 1101),
    Field("TriggerPrice", 1102, "double"),
    Field("TriggerTradingSessionID", 1113),
    Field("TriggerSymbol", 1103),
    Field("triggerSecurityID", 1104),
    Field("TriggerSecurityIDSource", 1105),
    Field("TriggerPriceType", 1107),
    Field("TriggerPriceDirection", 1109),
    Field("TimeInForce", 59),
    Field("TradingSessionID", 336),
    Field("ExpireDate", 432),
    Field("ExecInst", 18),
    Field("OrderCapacity", 528),
    Field("LeavesQty", 151, "double"),
    Field("CumQty", 14, "double"),
    Field("AvgPx", 6, "double"),
    Field("ExecRestatementReason", 378, "int"),
    Field("MultiLegReportingType", 442),
    Field("AllocID", 70),
    Field("CopyMsgIndicator", 797, "boolean"),
    Field("MatchIncrement", 1089, "double"),
    Field("MaxFloor", 111, "double"),
    Field("SettlCurrAmt", 119, "double"),
    Field("OptPremiumAmt", 20015),
    Field("OrderReference", 20009),
    Field("OpenCloseIndicator", 20199),
)

# further tags that may stand inside an entry of a group, besides those of its table
NO_LEGS_MEMBERS = (
    604, 605, 606, 607, 608, 609, 610, 611, 612, 613, 614, 615, 616, 617, 618, 619, 620, 621, 622, 623, 624, 682, 683, 684,
    685, 687, 690, 556, 564, 565, 566, 587, 588, 654, 670, 671, 672, 673, 674, 675, 687, 688, 689, 739, 740, 955, 956, 990, 999,
    1001, 1017, 1067, 1068, 1069, 1070, 1071, 1073, 1074, 1075, 1152, 1188, 1189, 1190, 1191, 1212, 1224, 1358, 1366, 1379, 1381,
    1383, 1384, 1420, 1436, 1440, 539, 524, 525, 538, 804, 545, 805)
NO_SIDES_MEMBERS = (
    1, 11, 12, 13, 15, 18, 37, 40, 58, 59, 63, 64, 65, 77, 78, 79, 80, 81, 83, 110, 118, 119, 120, 136, 137, 138, 139, 152, 154, 155, 156,
    157, 158, 159, 198, 203, 221, 230, 231, 232, 233, 234, 237, 238, 258, 259, 288, 289, 336, 354, 355, 376, 377, 381, 430, 447, 448, 452,
    453, 467, 479, 483, 497, 518, 519, 520, 521, 523, 526, 528, 529, 575, 576, 577, 578, 579, 581, 582, 584, 585, 591, 625, 635, 641,
    660, 661, 729, 736, 752, 756, 757, 758, 759, 760, 761, 762, 763, 764, 765, 767, 768, 769, 770, 776, 779, 781, 782, 783, 784, 786, 801,
    802, 803, 806, 807, 821, 825, 826, 891, 920, 921, 922, 943, 982, 986, 987, 989, 1005, 1006, 1007, 1008, 1009, 1016, 1029, 1057,
    1072, 1115, 1139, 1154, 1155, 1158, 1427, 1428, 1429, 1444)

NO_LEGS = 555
LEG_FIELDS = (
    Field("LegSymbol", 600),
    Field("LegSecurityID", 602),
    Field("LegSecurityIDSource", 603),
    Field("LegLastPx", 637, "double"),
    Field("LegLastQty", 1418, "double"),
    Field("LegTrdMatchID", 20200),
)

QUOTE_FIELDS = (
    Field("QuoteID", 117),
    Field("QuoteType", 537, "int"),
    Field("QuoteCancelType", 298, "int"),
    *INSTRUMENT,
    Field("BidPx", 132, "double"),
    Field("OfferPx", 133, "double"),
    Field("BidSize", 134, "double"),
    Field("OfferSize", 135, "double"),
    Field("QuoteStatus", 297, "int"),
    Field("Account", 1),
    Field("OrderCapacity", 528),
    Field("CopyMsgIndicator", 797, "boolean"),
)

TRADE_FIELDS = (
    Field("TradeReportID", 571),
    Field("TradeID", 1003),
    Field("OrigTradeID", 1126),
    Field("TradeReportRefID", 572),
    Field("SecondaryTradeReportID", 818),
    Field("TradeReportTransType", 487, "int"),
    Field("TradeReportType", 856, "int"),
    Field("TrdType", 828, "int"),
    Field("TrdSubType", 829, "int"),
    Field("MatchStatus", 573),
    Field("TrdMatchID", 880),
    Field("ComboMatchID", 20034),
    Field("PreviouslyReported", 570, "boolean"),
    *INSTRUMENT,
    Field("LastQty", 32, "double"),
    Field("LastPx", 31, "double"),
    Field("SettlementPrice", 730, "double"),
    Field("SettlCurrAmt", 119, "double"),
    Field("TradeDate", 75),
    Field("SettlDate", 64),
    Field("ClearingBusinessDate", 715),
    Field("SecondaryTrdType", 855, "int"),
    Field("CopyMsgIndicator", 797, "boolean"),
)

NO_SIDES = 552
SIDE_FIELDS = (
    Field("Side", 54),
    Field("Account", 1),
    Field("OrderID", 37),
    Field("AllocID", 70),
)

LOGON_ERROR = "LogonException"
# ------------------------------------------------------------------------------

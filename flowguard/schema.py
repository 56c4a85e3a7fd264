"""Wire and file schemas.

All wire messages are positional CSV; every field arrives as a string and is cast with
``try_cast`` later, so the schemas here are lists of names.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Field names and order are the wire contract.
NETFLOW48 = (
    "ts te td sa da sp dp pr flg fwd stos ipkt ibyt opkt obyt in out sas das smk dmk dtos dir nh nhb "
    "svln dvln ismc odmc idmc osmc mpls1 mpls2 mpls3 mpls4 mpls5 mpls6 mpls7 mpls8 mpls9 mpls10 "
    "cl sl al ra eng exid tr"
).split()
DERIVED14 = "tpkt tbyt cp prtcp prudp pricmp prigmp prother flga flgs flgf flgr flgp flgu".split()
RATIOS8 = "pktips pktops bytips bytops bytippkt bytoppkt bytipo pktipo".split()
NETFLOW12 = "ts te td sa da sp dp pr flg stos ipkt ibyt".split()
NETFLOW62 = NETFLOW48 + DERIVED14
NETFLOW71 = NETFLOW48 + ["zeek"] + RATIOS8 + DERIVED14
CONN = (
    "ts uid id.orig_h id.orig_p id.resp_h id.resp_p proto service duration orig_bytes resp_bytes "
    "conn_state local_orig local_resp missed_bytes history orig_pkts orig_ip_bytes resp_pkts "
    "resp_ip_bytes tunnel_parents"
).split()

# Detector names in serialisation order, and the length of their feature list.
MODULES = ["MIDAS", "AE", "GANomaly", "IFOREST", "ZEEKFLOW"]
MODULE_FEATURES = {"MIDAS": 0, "AE": 33, "GANomaly": 0, "IFOREST": 33, "ZEEKFLOW": 0}

# Window lengths in seconds and the 33 model features in model order.
WINDOWS = (10, 60, 600)
COUNT_FEATURES = ["sp", "dp", "da"]
MEAN_FEATURES = ["td", "pr", "flg", "stos", "ipkt", "ibyt"]
MODEL_FEATURES = (
    ["td", "ipkt", "ibyt", "flg", "pr", "stos"]
    + [f"{c}_{w}_mean" for c in COUNT_FEATURES for w in WINDOWS]
    + [f"{c}_{w}_mean" for c in MEAN_FEATURES for w in WINDOWS]
)

BY_WIDTH = {12: NETFLOW12, 48: NETFLOW48, 62: NETFLOW62, 71: NETFLOW71}


def string_schema(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


KAFKA_RECORD = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

RESULT_SCHEMA = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("module", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("is_anomalous", T.BooleanType()),
        T.StructField("features", T.StringType()),
        T.StructField("arrival", T.LongType()),
    ]
)

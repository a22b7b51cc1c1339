"""Split rules of public datasets, as rows for ``assign_splits``.

A scene that matches no rule is in no split.  Rules of other datasets are given
as tables of the same form; ``listed`` and ``prefixed`` make them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.filters import assign_splits

Rule = tuple[str, int, str, str, list[str]]

# Training scenes of uavscenes; its other scenes are in no split.
UAVSCENES_TRAIN = (
    "interval5_AMtown01",
    "interval5_AMtown02",
    "interval5_AMtown03",
    "interval5_AMvalley01",
    "interval5_AMvalley02",
    "interval5_AMvalley03",
    "interval5_HKairport01",
    "interval5_HKairport02",
    "interval5_HKairport03",
    "interval5_HKairport_GNSS01",
    "interval5_HKairport_GNSS02",
    "interval5_HKairport_GNSS03",
    "interval5_HKairport_GNSS_Evening",
    "interval5_HKisland01",
    "interval5_HKisland02",
    "interval5_HKisland03",
    "interval5_HKisland_GNSS01",
    "interval5_HKisland_GNSS02",
    "interval5_HKisland_GNSS03",
    "interval5_HKisland_GNSS_Evening",
)

# Noisy scenes of blendedmvs, which are in no split.
BLENDEDMVS_NOISE = (
    "5692a4c2adafac1f14201821",
    "5864a935712e2761469111b4",
    "59f87d0bfa6280566fb38c9a",
    "58a44463156b87103d3ed45e",
    "5c2b3ed5e611832e8aed46bf",
    "5bf03590d4392319481971dc",
    "00000000000000000000001a",
    "00000000000000000000000c",
    "000000000000000000000000",
)

# Validation scenes of blendedmvs; the rest trains.
BLENDEDMVS_VAL = (
    "000000000000000000000006",
    "000000000000000000000015",
    "000000000000000000000016",
    "00000000000000000000001b",
    "00000000000000000000001d",
    "584bd5587072670e72bffe39",
    "584c9ad27072670e72c060c5",
    "584dfe467072670e72c1665a",
    "584fe07f7072670e72c32e59",
    "585203546789802282f2aaf5",
    "58563650804be1058523da55",
    "5857aa5ab338a62ad5ff4dbe",
    "585834cdb338a62ad5ffab4d",
    "586133c2712e2761468ecfe3",
    "5863915b712e276146909135",
    "5863edf8712e27614690cce0",
    "58647495712e27614690f36d",
    "5864b076712e27614691197e",
    "58660e79712e27614691fe3d",
    "58676c36833dfe3f7b88b7f2",
    "586b4c459d1b5e34c282e66d",
    "586b8f149d1b5e34c283497c",
    "5880675a2366dd5d06e570ca",
    "588084032366dd5d06e59e82",
    "5880e3422366dd5d06e5ff8e",
    "5881fee18ce2c2754d0723f8",
    "588457b8932ba84fbed69942",
    "588a9c5fec4d5a1c088ec350",
    "588aff9d90414422fbe7885a",
    "5890279190414422fbea9734",
    "5899cfa6b76d7a3780a4cb64",
    "58a07ce53d0b45424799fdde",
    "58a1f5d74a4d262a170b65fc",
    "58cf4771d0f5fb221defe6da",
    "58f73e7c9f5b56478738929f",
    "591a467a6109e14d4f09b776",
    "591cf3033162411cf9047f37",
    "59bf97fe7e7b31545da34439",
    "59ecfd02e225f6492d20fcc9",
    "5a4a38dad38c8a075495b5d2",
    "5a77b46b318efe6c6736e68a",
    "5a8315f624b8e938486e0bd8",
    "5aa515e613d42d091d29d300",
    "5acf8ca0f3d8a750097e4b15",
    "5ae2e9c5fe405c5076abc6b2",
    "5b271079e0878c3816dacca4",
    "5b37189a35304b6f75e7583e",
    "5bce7ac9ca24970bce4934b6",
    "5bd43b4ba6b28b1ee86b92dd",
    "5c0d13b795da9479e12e2ee9",
)

# Test scenes of a set for the ambiguity of field of view and height; its other scenes are in no split.
AMBIGUITY_TEST = (
    "e1b883efa2b8768cfab20347",
    "71040e8faffc08ba7082b029",
    "fa73d296a111a7e3e973f237",
    "23dcba4dffe0c6bf0f59042e",
    "179e2063c562a60e3308d99a",
    "647ac219f9bf5eb6154d0f2b",
    "3b6bb1e3910ef5b714da4f28",
    "1cb8e5e8baf385a3cb2dcf9a",
    "7392aec7502366689224419c",
    "768416ab0299c27d86bf292b",
    "a73bdd58a0e011e8e415e625",
    "f6302ec5904cd552d3fda600",
    "a4d4c5752f7a802fd1871d09",
    "5e1ed8ee3c7f5951664de02c",
    "9ef090e43e5036b438022bac",
    "f74808af2ee1b0430f5e1cb2",
    "c11ff72f5113f4f111d89dbd",
    "9d64efeb3ecfd03c26161c18",
    "20eed7076da120a7d398df66",
    "9777b95bc27e62b2674937ff",
    "2158192f4299118faf68f4fc",
    "b276a6c7098388ff1bbcded5",
    "e3a928e88f9643a03c8a1adc",
    "19ec8ddb25b71a5be6976b93",
    "6b2399f2b4821c795dcf57ea",
    "667452d4325d8916a88db95a",
    "e63c154a77fb5ca738875320",
    "652584ec9dff985cecebcf3a",
    "078dbc15de74d692b0b30787",
    "1c79ba1167b39cddf16b9c38",
    "64bdf3e8e7a1f57668f00bf8",
    "51e2d0bb51027f115b78f914",
)

# Prefixes of scenes of a real set that are both validated and tested; the rest trains.
REAL_TEST_PREFIXES = ("nanfang_", "yanghaitang_", "xiaoxiang_")


def listed(dataset: str, names, splits: list[str], first: int = 0) -> list[Rule]:
    return [(dataset, first + i, "name", n, splits) for i, n in enumerate(names)]


def prefixed(dataset: str, prefixes, splits: list[str], first: int = 0) -> list[Rule]:
    return [(dataset, first + i, "prefix", p, splits) for i, p in enumerate(prefixes)]


def all_of(dataset: str, splits: list[str], order: int = 10_000) -> list[Rule]:
    return [(dataset, order, "all", "", splits)]


def public_rules() -> list[Rule]:
    """Rules of the public datasets; the first that matches decides."""
    return [
        *prefixed("whu_whuomvs", ["whuomvs"], []),
        *all_of("whu_whuomvs", ["train"]),
        *listed("uavscenes", UAVSCENES_TRAIN, ["train"]),
        *prefixed("ortholoc", ["test_inPlace", "test_outPlace"], ["test"]),
        *prefixed("ortholoc", ["train"], ["train"], 10),
        *prefixed("ortholoc", ["val"], ["val"], 20),
        *all_of("wilduav", ["train"]),
        *listed("blendedmvs", BLENDEDMVS_NOISE, []),
        *listed("blendedmvs", BLENDEDMVS_VAL, ["val"], 100),
        *all_of("blendedmvs", ["train"]),
        *(r for d in ("usegeo", "urbanscene3d", "enrich") for r in all_of(d, ["val", "test"])),
    ]


def real_rules(dataset: str) -> list[Rule]:
    """Rules of a real set under its name: some places are validated and tested, the rest trains."""
    return [*prefixed(dataset, REAL_TEST_PREFIXES, ["val", "test"]), *all_of(dataset, ["train"])]


def ambiguity_rules(dataset: str) -> list[Rule]:
    """Rules of a set for the ambiguity of field of view and height, under its name: it is only tested."""
    return listed(dataset, AMBIGUITY_TEST, ["test"])


def rule_table(spark: SparkSession, rules: list[Rule] | None = None) -> DataFrame:
    return spark.createDataFrame(public_rules() if rules is None else rules, "dataset string, rule_order int, kind string, pattern string, splits array<string>")


def splits_of(spark: SparkSession, scenes: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """(dataset, scene, split) of scenes (dataset, scene); several splits give several rows."""
    return assign_splits(scenes, rule_table(spark, rules))

"""Site-id and event-id corrections of the newest lab batch (DOM-15, DOM-16).

FIXED VALUES, in their original order.  ``SITE`` holds (old, new) site-id
corrections; each is applied in sequence to the running value (order
matters, see SURVEY 2.15 Q5).  ``EVENT`` holds exact event-id corrections.
Use ``site_rules()`` / ``event_map()`` below; other batches pass their own
tables to the same functions.
"""

# --- fixed values: site-id corrections (old, new), in order -------------------
SITE = [
    ('12-SAUQ-2.2', '12-SAUQ-1.7'),
    ('13-LHUD-105', '13-LHUD-105.0'),
    ('14-LBEV-0.1', '14-LBEV_T03-0.1'),
    ('14-LBEV-0.4', '14-LBEV_T01-0.4'),
    ('14-LBEV-0.3', '14-LBEV_T04-0.3'),
    ('11-TWNS-0.2', '11-STEB-0.2'),
    ('11-TWNS-1.1', '11-STEB-1.1'),
    ('06-BIBS-0.3', '06-JENC-0.3'),
    ('06-BIBS-6.6', '06-JENC-6.6'),
    ('12-BATV-11.5', '12-MITB-0.1'),
    ('13-BVRD-0.8', '13-SHIR-0.8'),
    ('13-BVRD-1.0', '13-SHIR-1.0'),
    ('13-BVRD-2.8', '13-SHIR-2.8'),
    ('13-BVRD-4.8', '13-SHIR-4.8'),
    ('05-CAMP- 1.5', '05-CAMB-1.5'),
    ('06-FABS-5.0', '06-TOLF-1.8'),
    ('12-SCHE-0.6', '12-BRWC-0.6'),
    ('12-SCHE-0.8', '12-COWC-0.8'),
    ('05-SEEL-0.5', '05-MLIC-0.5'),
    ('11-SNOK-0.3', '11-SNOK_L-0.3'),
    ('13-TACK-0.1', '13-SPAR_T10-0.1'),
    ('06-CATH_T9_3a-0.5', '05-CATH_T9_3a-0.5'),
    ('07-SKAT_1-0.2', '07-SKAT_T89-0.2'),
    ('07-CAYG_2-1.1', '07-CAYG-1.1'),
    ('07-BSWP_1.3', '07-BSWP-1.3'),
    ('13-LINK-2.3', '15-LINK-2.3'),
    ('07-GROU_1-1.5', '07-GROU-1.5'),
    ('04-BAKE-0.3', '04-BKER-0.3'),
    ('07-BLKC-2.8', '11-BLKC-2.8'),
    ('07-BLCK-2.8', '11-BLKC-2.8'),
    ('07-BUTN-0.6', '07-BTNC-0.6'),
    ('14-COLE-0.4', '14-CCLV-0.4'),
    ('05-CRAN-0.1', '05-CRBP-0.1'),
    ('07-DEAN-1.9', '07-DNCR-1.9'),
    ('07-FISC-1.3', '07-FSHR-1.3'),
    ('10-JACK-0.2', '10-JKBR-0.2'),
    ('08-LIME-6.7', '08-LMKN-6.7'),
    ('13-SILV-4.5', '13-SILS-4.5'),
    ('04-COHO_T41-0.1', '05-COHO_T41-0.1'),
    ('07-SPRN_T7-0.1', '04-SPRN_T7-0.1'),
    ('07-SENP_T32-0.6', '04-SENP_T32-0.6'),
    ('07-MUDG_T72-0.3', '04-MUDG_T72-0.3'),
    ('12-DWAS-7.2', '11-DWAS-7.2'),
    ('04-GRIM-6.3', '07-GRIM-6.3'),
    ('02-JNSN-2.3', '03-JNSN-2.3'),
    ('02-MUDC-0.4', '03-MUDC-0.4'),
    ('04-TNCR-3.7', '05-TNCR-3.7'),
    ('03-WCAN-73.0', '04-WCAN-73.0'),
    ('95-COHO-28.6', '05-COHO-28.6'),
    ('04-SXML-2.2', '07-SXML-2.2'),
    ('12-HVLY-0.5', '12-HLVY-0.5'),
    ('11-UHUD-42.5', '11-UHUD-43.1'),
    ('12-MOHK-3.7', '12-MOHK-1.5'),
    ('05-CHAU-14.9', '01-CHAU-14.9'),
    ('05-TOGA-1.5', '05-TOGA-1.3'),
    ('13-SPAR_T96-01', '13-SPAR_T9b-0.1'),
    ('13-TINW-4.55', '13-TINW-4.5'),
    ('13TINW-4.5', '13-TINW-4.5'),
    ('13TINW-6.5', '13-TINW-6.5'),
    ('15-DEFT_T1-0.5', '15-DEFT_T1-0.1'),
    ('15-DEFT_T1-0.2', '15-DEFT_T1-0.1'),
    ('13-STNY-8.1', '13-STNY-10.0'),
    ('14-GOUL-0.9', '14-COUL-0.9'),
    ('12-NORT-1.7', '12-NORT-2.3'),
    ('05-CHAU-4.2', '05-CHAU-4.0'),
    ('02-CLER_T6-3.1', '02-TWTY-3.1'),
    ('12-STLE-0.8', '12-STLE-0.2'),
    ('13-BRNX-5.6', '17-BRNX-5.6'),
    ('11-LRNC_21-20.2', '11-UHUD-64.4'),
    ('11-UHUD-14.7', '11-UHUD-14.8'),
    ('11-UHUD-27.5', '11-UHUD-27.4'),
    ('11-UHUD-32.1', '11-UHUD-32.4'),
    ('11-UHUD-39.5', '11-UHUD-40.1'),
    ('11-UHUD-39.8', '11-UHUD-40.3'),
    ('11-UHUD-42.5', '11-UHUD-43.1'),
    ('11-UHUD-51.0', '11-UHUD-51.3'),
    ('11-UHUD-64.0', '11-UHUD-64.2'),
    ('11-UHUD-98.3', '11-UHUD-98.7'),
    ('11-UHUD-267.8', '11-UHUD-106.3'),
    ('11-UHUD-273.0', '11-UHUD-111.6'),
    ('11-UHUD-284.9', '11-UHUD-124.2'),
    ('11-UHUD-286.0', '11-UHUD-124.7'),
    ('11-XHR-273.0', '11-UHUD-111.6'),
    ('11-XHR-277.0', '11-UHUD-115.6'),
    ('11-XHR-282.3', '11-UHUD-120.9'),
    ('11-XHR-285.0', '11-UHUD-124.3'),
    ('11-XHR-286.6', '11-UHUD-125.3'),
    ('13-LHUD-25.8', '13-LHUD-5.7'),
    ('13-LHUD-35.0', '13-LHUD-14.7'),
    ('13-LHUD-39.7', '13-LHUD-19.5'),
    ('13-LHUD-50.3', '13-LHUD-47.5'),
    ('13-LHUD-50.59', '13-LHUD-47.8'),
    ('13-LHUD-50.6', '13-LHUD-47.9'),
    ('13-LHUD-50.61', '13-LHUD-47.9'),
    ('13-LHUD-66.3', '13-LHUD-63.6'),
    ('13-LHUD-67.3', '13-LHUD-64.6'),
    ('13-LHUD-89.3', '13-LHUD-88.7'),
    ('13-LHUD-104.6', '13-LHUD-105'),
    ('13-LHUD-119.6', '13-LHUD-124.9'),
    ('13-LHUD-120.2', '13-LHUD-125.5'),
    ('13-LHUD-124.1', '13-LHUD-128.9'),
    ('13-LHUD-125.8', '13-LHUD-130.6'),
    ('13-LHUD-133.4', '13-LHUD-140.1'),
    ('13-LRNC_22-89.3', '13-LHUD-88.6'),
    ('13-LRNC_63-133.4', '13-LHUD-140.1'),
    ('13-LRNC_66-119.6', '13-LHUD-124.9'),
    ('03-YANT_T1C-0.2', '03-YANT_T1c-0.2'),
    ('17-GSCK_TA-0.1', '17-GSCK_Ta-0.1'),
    ('07-SKAT_T93A-0.5', '07-SKAT_T93a-0.5'),
    ('06-SANG_TB-0.1', '06-SANG_Tb-0.1'),
    ('05-CATH_T9_3A-0.5', '05-CATH_T9_3a-0.5'),
    ('07-SKAT_T93A-0.5', '07-SKAT_T93a-0.5'),
    ('14-CALL_E_T13A-0.1', '14-CALL_E_T13a-0.1'),
    ('09-STLW_T46A-0.1', '09-STLW_T46a-0.1'),
    ('07-SKAT_T93A-0.5', '07-SKAT_T93a-0.5'),
    ('12-SCHO_T93_B-1.8', '12-SCHO_T93_b-1.8'),
    ('13-SPAR_T9B-0.1', '13-SPAR_T9b-0.1'),
    ('17-BLND_TB-2.0', '17-BLND_Tb-2.0'),
    ('17-KENF_TA-0.2', '17-KENF_Ta-0.2'),
    ('07-KDIG_TB-0.7', '07-KDIG_Tb-0.7'),
    ('17-KENF_TA-0.2', '17-KENF_Ta-0.2'),
    ('17-BLND_TB-2.0', '17-BLND_Tb-2.0'),
    ('17-KENF_TA-0.2', '17-KENF_Ta-0.2'),
    ('17-BLND_TB-2.0', '17-BLND_Tb-2.0'),
    ('13-SPAR_T9B-0.1', '13-SPAR_T9b-0.1'),
    ('02-WRGT_TA-1.8', '02-WRGT_Ta-1.8'),
    ('13-LHUD-47.91', '13-LHUD-47.9'),
    ('05-MILD_T7-0.3', '04-MILD_T7-0.3'),
    ('12-SMIB-0.5', '10-SMIB-0.5'),
    ('04-PBLO-3.3', '04-PLBO-3.3'),
    ('13-FISH-21.21', '13-FISH-21.2'),
    ('13-WTRIBGL-0.06', '13-WTRIBGL-0.1'),
    ('13-ETRIBGL-0.15', '13-ETRIBGL-0.1'),
    ('13-WICBR-0.28', '13-WICBR-0.3'),
]

# --- fixed values: exact event-id corrections (old, new) -----------------------
EVENT = [
    ('12-MOYR-5.1_20100729', '12-MOYR-5.1_20100728'),
    ('12-OTSO -1.1_20200714', '12-OTSO-1.1_20200714'),
    ('01-LBUF-2.5_20200917', '01-LBUF-2.5_20200915'),
    ('02-WFREN_T12-0.2_20210915', '02-WFREN_T12-0.5_20210915'),
    ('1-BUFF-1.7_20200902', '1-BUFF-1.7_20200901'),
    ('01-BUFF-1.7_20200902', '01-BUFF-1.7_20200901'),
    ('11-WBLA-0.9_20210803', '11-WBLA-0.9_20210805'),
    ('04-UGNS-139.6_20220929', '04-UGNS-139.6_20220921'),
    ('05-COHO_T1-0.1_20220830', '05-COHO_T1-0.1_20220831'),
    ('05-FIVM-13.0_20220830', '05-FIVM-13.0_20220831'),
    ('05-STEO_T22-0.2_20220830', '05-STEO_T22-0.2_20220831'),
    ('06-SUSQ-36.9_20220713', '06-SUSQ-36.9_20220712'),
    ('08-FALK-0.3_20220914', '08-FALK-0.3_20220915'),
    ('08-MILE-0.7_20220914', '08-MILE-0.7_20220915'),
    ('08-TANE-0.7_20220913', '08-TANE-0.7_20220914'),
    ('13-SPAR-3.6_20220714', '13-SPAR-3.6_20220719'),
    ('12-SPIT-2.3_20210723', '12-SPIT-2.3_20200723'),
    ('12-WESK-0.1_20200716', '12-WESK_T5-0.1_20200716'),
    ('07-CANO-2.3_20210721', '07-CANO-0.8_20210721'),
    ('07-DEAN-0.1_20210721', '07-DEAN-1.9_20210721'),
    ('13-ESOP-4.4_20220720', '13-ESOP-4.8_20220720'),
    ('13-TIOR-0.2_20220720', '13-TIOR-0.1_20220720'),
    ('07-FISC-0.1_20210722', '07-FISC-1.3_20210722'),
    ('07-POTT-0.7_20210831', '07-POTT-0.1_20210831'),
    ('07-RHCR-0.8_20210713', '07-RHCR-0.7_20210713'),
    ('07-RHCR-0.8_20210901', '07-RHCR-0.7_20210901'),
    ('11-UHUD-125.3_20210803', '11-UHUD-124.7_20210803'),
    ('01-CHAU-4.2_20220922', '01-CHAU-4.0_20220922'),
    ('05-CDEA-11.4_20220831', '05-CDEA-11.5_20220831'),
    ('05-CHEM-33.8_20220830', '05-CHEM-33.6_20220830'),
    ('05-COHO-1.4_20220830', '05-COHO-1.5_20220830'),
    ('05-PURD-0.1_20220831', '05-PURD-0.2_20220831'),
    ('08-BLCK-30.0_20220802', '08-BLCK-30.4_20220802'),
    ('08-LIME-6.3_20220914', '08-LIME-6.7_20220914'),
    ('08-WHET-4.8_20220914', '08-WHET-4.9_20220914'),
    ('11-XHR-296.0_20210803', '11-UHUD-296.7_20210803'),
    ('05-MDCR-10.0_20220821', '05-MDCR-10.0_20220831'),
    ('05-MEAD-10.8_20220831', '05-MEAD-10.9_20220830'),
    ('07-VENS-1.8_20210722', '07-VENE-1.5_20210722'),
    ('03-LSTN-1.0_20200801', '03-LSTN-1.0_20200819'),
    ('08-ADKS_36-0.5_20220914', '08-ADKS_36-0.6_20220914'),
    ('08-BLCK_T132-2.0_20220915', '08-BLCK_T132-1.8_20220915'),
    ('09-BRND-2.5_20210728', '09-BRND-1.6_20210728'),
    ('09-COLE-2.9_20210727', '09-COLE-3.6_20210727'),
    ('09-COLE-4.6_20210727', '09-COLE-4.2_20210727'),
    ('12-FOX-1.1_20220809', '12-FOX-1.1_20220810'),
    ('13-LHUD_T299-2.5_20220720', '13-LHUD_T229-2.5_20220720'),
    ('13-WFKIL-0.1_20220721', '13-WFKIL-0.4_20220721'),
    ('16-SUSQ-25.2_20220712', '06-SUSQ-25.2_20220712'),
    ('10-JACK-0.2_20230726T1030', '10-JKBR-0.2_20230726T1030'),
    ('04-PLBO-3.3_20240711T0845', '04-PBLO-3.3_20240711T0845'),
    ('13-ETRIBGL-0.15_20240717T1200', '13-ETRIBGL-0.1_20240717T1200'),
    ('13-FISH-21.21_20240716T1600', '13-FISH-21.2_20240716T1600'),
    ('13-WICBR-0.28_20240717T1200', '13-WICBR-0.3_20240717T1200'),
    ('13-WTRIBGL-0.06_20240717T1600', '13-WTRIBGL-0.1_20240717T1600'),
]


def site_rules(parity: bool = False) -> list[tuple]:
    """Ordered rules for ``ordered_replace`` / ``correct_distinct``.

    Default: each old id must match the whole site part of the value
    (literal, dots are dots) with an optional ``_yyyyMMdd...`` event tail
    kept.  ``parity=True`` applies the old ids as raw, unanchored regexes
    exactly like the source (where ``13-LHUD-105`` also rewrites
    ``13-LHUD-105.0`` to ``13-LHUD-105.0.0``).
    """
    from stonefly.functions.text import whole_id_rules
    if parity:
        return [(old, new, False) for old, new in SITE]
    return whole_id_rules(SITE)


def event_map() -> dict:
    """Exact event-id corrections as a map for ``lookup.case_map``."""
    return dict(EVENT)

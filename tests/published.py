"""Published scores and ranks of the win study, used to check scaling, averaging and ranking."""

# Scaled scores per feature, in the order of METHODS, then the average.
SCORES = {
    "dreb": (1.0, 1.0, 0.5628477185853729, 1.0, 1.0, 1.0, 0.9271412864308956),
    "ast": (0.4817520238973673, 0.43630065349671443, 0.06417330305496169, 0.8839811779159876, 0.8881806292503652, 0.21725907622125062, 0.4952744773061078),
    "fg2m": (0.30618202475903994, 0.28474828264735397, 0.6154550277943197, 0.4392549687902104, 0.4941587978077683, 0.27795729582462136, 0.4029593996038856),
    "pts_off_turnovers": (0.4233499960677343, 0.4681238850716476, 0.2170398117727864, 0.41382057375470455, 0.45339300547766087, 0.32617373122980403, 0.38365016722905626),
    "assist_to_turnover": (0.39928079010423123, 0.17400553187711026, 0.0, 0.4949109622621938, 0.8230397289785086, 0.0371285560413102, 0.3213942615438924),
    "fg3m": (0.1872157449733268, 0.22438900217551563, 0.7891507848237146, 0.21833991422141324, 0.2945213995423498, 0.2141544699993664, 0.3212952192892811),
    "ftm": (0.2673872027937925, 0.3783951737860779, 0.2894012141243398, 0.22304465982127542, 0.26644236987296943, 0.22612937971234878, 0.2751333333518006),
    "fg3a": (0.16196276982605498, 0.17133992890706082, 1.0, 0.0, 0.04308009788281704, 0.10542989292276495, 0.24696878158978297),
    "opp_pts_off_turnovers": (0.23715124319420697, 0.1502421656039013, 0.1538727666623195, 0.4003321907278096, 0.4293705328936812, 0.08205030729265661, 0.24216986772909588),
    "pace": (0.348169901811533, 0.35209140004906087, 0.1623683185632, 2.6478215332034975e-05, 0.0, 0.29607805867072157, 0.19312235955164125),
    "fg2a": (0.14937735824108647, 0.06997933991152805, 0.7621687154131054, 0.014940090394324406, 0.0, 0.085978584553, 0.18040734808550737),
    "opp_paint_pts": (0.23876606860548633, 0.14691427615783748, 0.04913035269973456, 0.2246668676469683, 0.2646113459244672, 0.08952670594943929, 0.16893593616398886),
    "stl": (0.0862427806515366, 0.07180846560465803, 0.20464442342680889, 0.16171855787080472, 0.18328483208626756, 0.08369764936957472, 0.1318994515016084),
    "opp_fast_break_pts": (0.17012448827618293, 0.05838633792614352, 0.01633469212814317, 0.2081828874392617, 0.28977380484162973, 0.035734651206994913, 0.12975614363639265),
    "blk": (0.07966888200020872, 0.05615965154170624, 0.08359243310344726, 0.22554897507210525, 0.25794371821558026, 0.05512260026610907, 0.12633937669985945),
    "fta": (0.18117315046601115, 0.0011183788320608251, 0.12084992824627501, 0.14780750531887837, 0.1856516918807009, 0.0876892859405689, 0.12071499011408253),
    "pf": (0.14346717334280357, 0.10426894976602978, 0.08758165255050719, 0.12244789287615614, 0.12191002262256288, 0.05005385541405294, 0.10495492442868543),
    "paint_pts": (0.06491136719831773, 0.0, 0.06326978347738542, 0.22083439508209815, 0.20725501653437733, 0.004498511056199574, 0.0934615122247297),
    "ft_pct": (0.14701470451268275, 0.0, 0.010792992412505763, 0.08489675009390883, 0.2167335172215951, 0.04099347399100291, 0.08340523970528256),
    "fast_break_pts": (0.07685378116266434, 0.0, 0.01859906110994067, 0.2075778805948726, 0.1785430878428862, 0.0, 0.08026230178506062),
    "tov": (0.0, 0.0, 0.15073617173151657, 0.10465596035128677, 0.1853117259539047, 0.008616866248495128, 0.07488678738086718),
    "oreb": (0.022629690420736072, 0.0003244134466767987, 0.27469102033184495, 0.010466147818627066, 0.022080943656423047, 0.010644364189317468, 0.05680609664393757),
    "second_chance_pts": (0.06254950539144062, 0.0036324445020383452, 0.043297391584034665, 0.03045289156106107, 0.04805616445668398, 0.018690996641956517, 0.034446565689535864),
    "opp_second_chance_pts": (0.05678399851225862, 0.0002492848359551188, 0.02181464747838321, 0.02845216517549865, 0.03516318320552119, 0.013685611100551071, 0.02602481505136131),
}
# Ranks per feature, in the same order.
RANKS = {
    "dreb": (1, 1, 5, 1, 1, 1, 1),
    "ast": (2, 3, 16, 2, 2, 6, 2),
    "fg2m": (6, 6, 4, 4, 4, 4, 3),
    "pts_off_turnovers": (3, 2, 8, 5, 5, 2, 4),
    "assist_to_turnover": (4, 8, 24, 3, 3, 17, 5),
    "fg3m": (10, 7, 2, 11, 7, 7, 6),
    "ftm": (7, 4, 6, 9, 9, 5, 7),
    "fg3a": (13, 9, 1, 24, 20, 8, 8),
    "opp_pts_off_turnovers": (9, 10, 11, 6, 6, 13, 9),
    "pace": (5, 5, 10, 23, 23, 3, 10),
    "fg2a": (14, 14, 3, 21, 23, 11, 11),
    "opp_paint_pts": (8, 11, 18, 8, 10, 9, 12),
    "stl": (17, 13, 9, 14, 16, 12, 13),
    "opp_fast_break_pts": (12, 15, 22, 12, 8, 18, 14),
    "blk": (18, 16, 15, 7, 11, 14, 15),
    "fta": (11, 18, 13, 15, 14, 10, 16),
    "pf": (16, 12, 14, 16, 18, 15, 17),
    "paint_pts": (20, 21, 17, 10, 13, 23, 18),
    "ft_pct": (15, 21, 23, 18, 12, 16, 19),
    "fast_break_pts": (19, 21, 21, 13, 17, 24, 20),
    "tov": (24, 21, 12, 17, 15, 22, 21),
    "oreb": (23, 19, 7, 22, 22, 21, 22),
    "second_chance_pts": (21, 17, 19, 19, 19, 19, 23),
    "opp_second_chance_pts": (22, 20, 20, 20, 21, 20, 24),
}

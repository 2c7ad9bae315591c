"""Oracle side of the projections: the same closed forms written as SQL."""

from ..functions import projection as P


def lonlat_sql(x: str, y: str) -> str:
    """Select items ``lon`` and ``lat`` for equal-area metres."""
    dy = f"({P.RHO_0!r} - ({y}))"
    q = (f"(({P.CONE_C!r} - (({x}) * ({x}) + {dy} * {dy}) * "
         f"{P.CONE_N * P.CONE_N / P.SEMI_MAJOR**2!r}) / {P.CONE_N!r})")
    beta = f"asin({q} / {P.Q_POLE!r})"
    lat = (f"degrees({beta} + {P.AUTH_2!r} * sin(2 * {beta}) + {P.AUTH_4!r} * sin(4 * {beta})"
           f" + {P.AUTH_6!r} * sin(6 * {beta}))")
    return f"degrees(atan2({x}, {dy}) / {P.CONE_N!r}) + ({P.ORIGIN_LON!r}) AS lon, {lat} AS lat"


def utm_sql(lon: str, lat: str, zone: str) -> str:
    """Select items ``east`` and ``north`` for degrees and a zone."""
    lam = f"radians({lon} - ({zone} * 6 - 183))"
    s = f"sin(radians({lat}))"
    t = f"sinh(atanh({s}) - {P.E!r} * atanh({P.E!r} * {s}))"
    xi, eta = f"atan2({t}, cos({lam}))", f"atanh(sin({lam}) / sqrt(1 + {t} * {t}))"
    east, north = eta, xi
    for j, a in enumerate(P.TM_ALPHA, start=1):
        east += f" + {a!r} * cos({2 * j} * {xi}) * sinh({2 * j} * {eta})"
        north += f" + {a!r} * sin({2 * j} * {xi}) * cosh({2 * j} * {eta})"
    k = P.UTM_SCALE * P.RECTIFYING
    return f"{P.UTM_EASTING!r} + {k!r} * ({east}) AS east, {k!r} * ({north}) AS north"

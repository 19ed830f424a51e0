"""Parsing rules against the JDK's own classes (called through the Spark JVM).

Numbers: `parse_long` against java.lang.Long.parseLong on random strings of
signs, ASCII digits, spaces, dots and letters (Long.parseLong also reads
non-ASCII digits; log fields do not hold them).

URLs: `url_parts` against java.net.URL.

Random URLs of the shapes access logs hold: schemes with and without a Java
handler, user-info, hosts, good and bad ports, paths with spaces and pipes,
queries, fragments, UNC-style `scheme:////`, `mailto:`, and such URLs inside `jar:`.
"""

import random

from pyspark.sql import functions as F

from accesslake.functions import parse


def _java_parts(jvm, url):
    try:
        u = jvm.java.net.URL(url)
    except Exception:  # noqa: BLE001 - MalformedURLException through py4j
        return ("-", "-", "-", "-")
    query = u.getQuery()
    return (u.getProtocol(), u.getHost(), u.getPath(), query if query else "-")


def _urls(n, seed=11):
    rnd = random.Random(seed)

    def text(alphabet, lo, hi):
        return "".join(rnd.choice(alphabet) for _ in range(rnd.randint(lo, hi)))

    out = []
    for _ in range(n):
        scheme = rnd.choice(["http", "https", "HTTP", "ftp", "file", "Https", "foo", "x-y", "mailto"])
        sep = rnd.choice(["://", "://", "://", ":", ":/", ":////"])
        user = rnd.choice(["", "", "", "u@", "u:p@", "user:pa ss@", "a@b@", "@@", "a@"])
        host = text("abcxyz0189.-_", 0, 12)
        port = rnd.choice(["", "", ":80", ":", ":8080", ":x1", ":1x", ":+80", ":-1", ":-2", ":-", ":+0",
                           ":99999999999", ":2147483647", ":2147483648", ":007"])
        path = rnd.choice(["", "/", "/a", "/a/b.html", "/x y", "/p|q", "/a;b=c", "/%20"]) + text("ab/", 0, 3)
        query = rnd.choice(["", "", "?", "?a=1", "?a=1&b=2", "?q=a?b", "?x=/y"])
        frag = rnd.choice(["", "", "#", "#top", "#a?b", "#/x"])
        url = scheme + sep + user + host + port + path + query + frag
        if rnd.random() < 0.2:
            url = rnd.choice(["jar:", "JAR:", "jar:url:"]) + url + rnd.choice(["!/", "!/a?b", "!", "!/x!/y#z", "#!/"])
        out.append(url)
    return out


ODD = [
    "url:http://h/p", "URL:HTTP://h/p?q", "url:url:http://h/p", " url:http://h", "\x01\thttp://h/p?a=1\x1f ", "http://h/p\x00",
    "http://[::1]:80/p", "http://[::1]/p", "http://[::1]:x/p", "http://[1:2:3:4:5:6:7:8]:/p?x", "http://u@[fe80::1]:8080", "http://[1:2:3]/p",
    "http://[::1]x/p", "http://[]/p", "http://[::1", "http://[1::2::3]/", "http://[1:2:3:4:5:6:7::]/", "http://[1:2:3:4:5:6:7:8::]/",
    "http://[12345::]/", "jar:http://h/p",
    "http://[::ffff:1.2.3.4]:80/p", "http://[1:2:3:4:5:6:1.2.3.4]/", "http://[1:2:3:4:5:6:7:1.2.3.4]/", "http://[::1.2.3]/", "http://[::1.2.3.256]/",
    "http://[1.2.3.4]/", "http://[::a1.2.3.4]/", "http://[::1.2.3.4:5]/", "http://[00001::]/", "http://[::01.002.3.4]/",
    "http://[fe80::1%eth0]/p", "http://[fe80::1%25en0]:8080/p?q", "http://[fe80::1%]/p", "http://[%eth0]/", "http://[::1.2.3.4%a]/x",
    "mailto:a@b.org?subject=x#f", "mailto:", "mailto: ", "mailto:#x", "mailto: #x", "mailto://h:x/p?q", "MAILTO:[x",
    "jar:file:/a.jar!/b?c#d", "jar:http://h:x/a.jar!/b", "jar:foo:/a!/b", "jar:http://h/a#b!/c", "jar:!/x", "jar:mailto:a!/b", "jar:mailto: !/b",
    "jar:http://u@[::1]:80/a.jar!/b", "jar:http://[::1/a.jar!/b", "jar: http://h/a !/b", "jar:http:////h:x!/y", "jar:http://a@b@c:x/!/y",
]


def test_url_parts_equal_java_net_url(spark):
    urls = _urls(1500) + ODD
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    ours = [tuple(r) for r in df.select(*parse.url_parts(F.col("u"))).collect()]
    jvm = spark.sparkContext._jvm
    diff = [(u, j, o) for u, o in zip(urls, ours) if (j := _java_parts(jvm, u)) != o]
    assert not diff, (len(diff), diff[:12])


def _java_long(jvm, text):
    try:
        return jvm.java.lang.Long.parseLong(text)
    except Exception:  # noqa: BLE001 - NumberFormatException through py4j
        return None


def test_parse_long_equals_long_parselong(spark):
    rnd = random.Random(5)
    texts = ["".join(rnd.choice("+-0123456789 .e") for _ in range(rnd.randint(0, 21))) for _ in range(1500)]
    texts += ["9223372036854775807", "9223372036854775808", "-9223372036854775808", "-9223372036854775809",
              "+0", "-0", "007", "+", "-", ""]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    ours = [r[0] for r in df.select(parse.parse_long(F.col("t"))).collect()]
    jvm = spark.sparkContext._jvm
    diff = [(t, j, o) for t, o in zip(texts, ours) if (j := _java_long(jvm, t)) != o]
    assert not diff, diff[:5]

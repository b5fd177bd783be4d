"""Small alignment files made up for the tests, and a plain restatement of the rules they are judged by."""

import re

CONTIG_LENGTHS = {"alpha": 700_000, "beta": 350_000}
#: Limits that the cases are laid out around.
LONGEST_INSERT, LEAST_CLIP, READ = 286, 20, 90


def sam_header(order="coordinate", lengths=CONTIG_LENGTHS, extra=()):
    return [f"@HD\tVN:1.6\tSO:{order}", *[f"@SQ\tSN:{n}\tLN:{k}" for n, k in lengths.items()], *extra]


def read(name, flag, contig, pos, cigar, mate="*", mate_pos=0, tlen=0, mapq=0, bases=READ, tags=()):
    fields = [name, flag, contig, pos, mapq, cigar, mate, mate_pos, tlen, "A" * bases, "!" * bases, *tags]
    return "\t".join(str(f) for f in fields)


#: A pair without any evidence, which every file holds.
CALM = [read("calm", 99, "alpha", 40_000, "90M", "=", 40_160, 250), read("calm", 147, "alpha", 40_160, "90M", "=", 40_000, -250)]


def _rows(*rows):
    return [read("x", *r) for r in rows]


#: Rows of one template, and which of them show evidence by themselves.
CASES = {
    "both-forward": (_rows((65, "alpha", 12_500, "90M", "=", 12_680, 270), (129, "alpha", 12_680, "90M", "=", 12_500, -270)), {0, 1}),
    "both-reverse": (_rows((113, "beta", 900, "90M", "=", 1_050, 240), (177, "beta", 1_050, "90M", "=", 900, -240)), {0, 1}),
    "stretched": (_rows((99, "alpha", 23_000, "90M", "=", 23_810, 900), (147, "alpha", 23_810, "90M", "=", 23_000, -900)), {0, 1}),
    "longest-normal": (_rows((99, "alpha", 24_000, "90M", "=", 24_196, 286), (147, "alpha", 24_196, "90M", "=", 24_000, -286)), set()),
    "across-contigs": (_rows((97, "alpha", 5_100, "90M", "beta", 77_000), (145, "beta", 77_000, "90M", "alpha", 5_100)), {0, 1}),
    "clipped-left": (_rows((99, "alpha", 61_000, "25S65M", "=", 61_150, 240), (147, "alpha", 61_150, "90M", "=", 61_000, -240)), {0}),
    "clipped-both": (_rows((163, "alpha", 81_000, "22S46M22S", "=", 81_120, 210), (83, "alpha", 81_120, "90M", "=", 81_000, -210)), {0}),
    "clip-too-short": (_rows((99, "alpha", 62_000, "19S71M", "=", 62_150, 240), (147, "alpha", 62_150, "71M19S", "=", 62_000, -240)), set()),
    "chimera": (
        _rows((99, "alpha", 90_010, "60M30S", "=", 90_170, 250), (147, "alpha", 90_170, "90M", "=", 90_010, -250))
        + [read("x", 2147, "beta", 3_000, "60H30M", "alpha", 90_170, 0, bases=30)],
        {0, 2},
    ),
    "mate-unaligned": (_rows((73, "alpha", 30_000, "90M", "=", 30_000), (133, "alpha", 30_000, "*", "=", 30_000)), set()),
    "end-of-contig": (_rows((99, "alpha", 699_700, "90M", "=", 699_931, 281), (147, "alpha", 699_931, "70M20S", "=", 699_700, -281)), {1}),
    "marked-copy": (_rows((1089, "alpha", 13_000, "90M", "=", 13_100, 190), (1153, "alpha", 13_100, "90M", "=", 13_000, -190)), set()),
    "over-window-edge": (_rows((65, "alpha", 109_700, "90M", "=", 109_900, 290), (129, "alpha", 109_900, "90M", "=", 109_700, -290)), {0, 1}),
}


def shows_evidence(line):
    """The rule for one row: usable, and clipped long enough or discordant."""
    name, flag, contig, _, _, cigar, mate, _, tlen, *_ = line.split("\t")
    flag = int(flag)
    if flag & (4 | 8 | 512 | 1024):
        return False
    ends = [re.match(r"(\d+)([SH])", cigar), re.search(r"(\d+)([SH])$", cigar)]
    hard_only = flag & (256 | 2048)
    if any(e and int(e.group(1)) >= LEAST_CLIP and (e.group(2) == "H" or not hard_only) for e in ends):
        return True
    elsewhere = flag & 1 and mate not in ("*", "=", contig)
    return bool(elsewhere or abs(int(tlen)) > LONGEST_INSERT or bool(flag & 16) == bool(flag & 32))


def scanned_twice(lines, size=10_000, overlap=200 + LONGEST_INSERT + READ):
    """Rows in the order in which two passes over each overlapping window write them."""
    known, out = set(), []
    for contig, length in CONTIG_LENGTHS.items():
        own = [x for x in lines if x.split("\t")[2] == contig]
        for window in range((length - 1) // size + 1):
            inside = []
            for x in own:
                offset = int(x.split("\t")[3]) - 1
                if offset // size <= window <= (offset + overlap) // size:
                    inside.append(x)
            for x in inside:
                if shows_evidence(x):
                    known.add(x.split("\t")[0])
                if x.split("\t")[0] in known:
                    out.append(x)
            out += [x for x in inside if x.split("\t")[0] in known]
    return out


def in_file_order(lines):
    """Sorted by contig and position."""
    order = list(CONTIG_LENGTHS)
    return sorted(lines, key=lambda x: (order.index(x.split("\t")[2]), int(x.split("\t")[3])))


def vcf_header(samples, contigs=("1", "2", "3")):
    columns = ["#CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT", *samples]
    return ["##fileformat=VCFv4.2", *[f"##contig=<ID={c},length=90000000>" for c in contigs], "\t".join(columns)]


def row(*fields):
    return "\t".join(str(f) for f in fields)

"""Column layouts shared by sources, plans and sinks, as DDL strings."""

#: Alignment rows. Positions are zero-based, -1 where absent. (file_ord, block, seq) is the row order.
ALIGNMENT = (
    "file_ord int, block bigint, seq bigint, qname string, flag int, tid int, contig string, pos bigint, "
    "mapq int, cigar string, left_hard int, left_soft int, right_hard int, right_soft int, mtid int, mcontig string, mpos bigint, tlen bigint, seq_len int, "
    "tags map<string,string>, raw string"
)

#: Order columns of rows read from files.
ORDER = ["file_ord", "block", "seq"]

#: Rows of a variant file. ``pos`` is zero-based; a flag in ``info`` has an empty text.
VARIANT = (
    "file_ord int, block bigint, seq bigint, chrom string, pos bigint, id string, ref string, alts array<string>, "
    "qual string, filters array<string>, info map<string,string>, format array<string>, "
    "calls array<struct<sample:string,fields:map<string,string>>>"
)

#: The JSON document in the fourth column of an evidence file; exactly one arm is set.
SIGNAL = (
    "SplitRead struct<read_id:bigint,is_first:boolean,contig:string,start:bigint,end:bigint,clipped_sides:string>, "
    "PairedRead struct<read_id:bigint,is_first1:boolean,contig1:string,start1:bigint,end1:bigint,strand1:string,"
    "contig2:string,start2:bigint,strand2:string,tlen:bigint>"
)

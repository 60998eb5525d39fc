"""peakloom: label-free quantification and record processing as Spark plans."""

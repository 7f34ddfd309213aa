"""Writers: page tables, page files, site digests and reports."""

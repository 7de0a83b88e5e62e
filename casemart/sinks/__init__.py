"""Writers: layers, exports, snapshots and the audited publication of a mart."""

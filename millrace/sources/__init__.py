"""Readers and writers of corpora, verdicts, directory trees and versioned outputs."""

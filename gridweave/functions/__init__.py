"""gridweave.functions"""

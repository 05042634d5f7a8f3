"""weftline.operators"""
